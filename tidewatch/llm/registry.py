"""The registered queries of this package, and their SQL twins."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import decontaminate, exact_dedup, fertility, license_scan, near_copies, prefix_trie, quality, sentencepieces, spelling, substring_dedup, token_counts, toxicity, url_filter

from tidewatch.llm.labels import remainder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# The rules of the contract: host, path, verdict.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
TOKENIZER = "piece_bpe_32k.model"
RANKS = "byte_bpe_50k.tiktoken"
TOKEN_LIMIT = 4096


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.license_scan(table(spark, sf_dir, "documents"))
    return found.withColumnRenamed("id", "doc_id").drop("matches")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.url_filter(table(spark, sf_dir, "pages"), rules).withColumnRenamed("id", "page_id")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.repeated_passages(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), F.col("other_id").alias("other_doc_id"), "start", "stop", "other_start", "other_stop",
        "functions",
    )


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_dedup.copy_groups(table(spark, sf_dir, "documents"))
    return groups.select(
        F.col("id").alias("doc_id"),
        "keep_id",
        F.col("n").alias("group_size"),
        F.col("keep").alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sentencepieces.round_trips(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return found.withColumnRenamed("id", "doc_id")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.trained(docs, table(spark, sf_dir, "labels"))
    return judged(quality.quality(docs, model), quality.PARTS, quality.HELD_OUT, quality.KEEP)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    machine = toxicity.trained(docs, table(spark, sf_dir, "labels"))
    return judged(toxicity.toxicity(docs, machine), toxicity.PARTS, toxicity.HELD_OUT, 0.5)


def judged(scores: DataFrame, parts: int, held_out: int, threshold: float) -> DataFrame:
    return scores.select(
        F.col("id").alias("doc_id"),
        (remainder("id", parts) == held_out).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", "n_items", "items_sha256",
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return counts.select(
        F.col("id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit")
    )


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_copies.near_copies(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fertility.quality_rules(
        table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), public_tokenizers.path(RANKS),
        public_tokenizers.PATTERN,
    )
    return found.withColumnRenamed("id", "doc_id")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_url_filter": op2_url_filter,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_quality": op6_quality,
    "op7_toxicity": op7_toxicity,
    "op8_decontamination": op8_decontamination,
    "op9_token_counts": op9_token_counts,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_quality_rules": op12_quality_rules,
    "op13_prefix_trie": op13_prefix_trie,
    "pipeline": corpus_pipeline.run,
}

# The unsigned crc32 of a text x, byte by byte, with the 256 remainders `t` of a table crc.
CRC = """list_reduce(
    list_prepend(4294967295, list_transform(range(0, octet_length(encode({x}))),
                 lambda i: ('0x' || substr(hex(encode({x})), 2 * i + 1, 2))::bigint)),
    lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)]))"""
CRC_TABLE = """crc as (select list(r order by b) t from (
    select b, list_reduce(list_prepend(b, range(8)), lambda c, i: xor(c >> 1, (c & 1) * 3988292384)) r
    from (select unnest(range(256)) b)))"""

# Words as single bytes, since the SQL function counts edits of bytes.
WIDE = "".join(map(chr, range(0xC0, 0x100)))
NARROW = "".join(chr(c) for c in range(0x21, 0x7F) if not chr(c).islower() and chr(c) != "'")[: len(WIDE)]

LOWER = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL = {
    "op4_exact_dedup": f"""
        with t as (select doc_id, sha256({LOWER.format('text')}) text_sha256 from documents)
        select doc_id, max(doc_id) over g keep_id, count(*) over g group_size,
               doc_id = max(doc_id) over g kept, text_sha256
        from t window g as (partition by text_sha256)""",
    "op2_url_filter": """
        with p as (select page_id, case when position('://' in coalesce(url, '')) > 0
                     then substr(url, position('://' in url) + 3) else '' end rest from pages),
        h as (select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz') host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) path from p),
        r(rhost, rpath, rverdict) as (values ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
            ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
        j as (select page_id, host, path, rhost || rpath rule, rverdict,
                row_number() over (partition by page_id order by length(rhost || rpath) desc nulls last) n
              from h left join r on (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath))
        select page_id, host, path, rule, coalesce(rverdict, 'allow') verdict from j where n = 1""",
    "op11_spelling_variants": rf"""
        with recursive {CRC_TABLE},
        runs as (select doc_id, w, count(*) c from (
                   select doc_id, unnest(regexp_extract_all({LOWER.format('text')}, '[a-zÀ-ÿ]+')) w from documents)
                 where length(w) >= 6 group by 1, 2),
        coded as (select w, c, xor({CRC.format(x="(coalesce(doc_id::varchar, '') || ':' || w)")}, 4294967295) h from runs, crc),
        kept as (select case when h % 199 = 0 then substr(w, 1, (h % length(w))::int) || substr(w, (h % length(w))::int + 2)
                        else w end word, c from coded),
        words as (select word, sum(c)::bigint n, translate(word, '{WIDE}', '{NARROW}') b from kept where length(word) >= 6 group by 1 having sum(c) >= 5),
        near as (select a.word, a.n, b.word other, b.n m from words a join words b
                 on abs(length(a.word) - length(b.word)) <= 1 and a.word <> b.word and levenshtein(a.b, b.b) = 1),
        best as (select word, count(*) n_near, arg_min(other, (-m, other)) other, max(m) m from near group by 1),
        found as (select words.word, n, coalesce(n_near, 0) n_near, case when m >= 5 * n then other end form,
                         case when m >= 5 * n then m end form_n from words left join best using (word)),
        walk as (select word, word root, form next from found
                 union all select walk.word, walk.next, found.form from walk join found on found.word = walk.next)
        select found.word, form, root, n, n_near, form_n from found join walk on walk.word = found.word and next is null""",
    "op13_prefix_trie": f"""
        with {CRC_TABLE},
        turns as (select conv_id, md5(coalesce(role, '') || chr(0) || coalesce(text, '')) t, length(coalesce(text, '')) chars,
                         row_number() over (partition by conv_id order by turn nulls first, role, text) i
                  from conversations where conv_id is not null),
        convs as (select conv_id, xor({CRC.format(x="conv_id::varchar")}, 4294967295) % 6 h
                  from (select distinct conv_id from turns), crc),
        parts as (select c.conv_id, i, 0 own, t, chars from convs c join turns b on b.conv_id = c.conv_id - c.conv_id % 100 and i <= h
                  union all
                  select c.conv_id, i, 1, t, chars from convs c join turns using (conv_id) where i > h),
        built as (select conv_id, row_number() over w d, string_agg(t, '') over w k, chars
                  from parts window w as (partition by conv_id order by own, i)),
        paths as (select conv_id, d, k, chars from built union all select conv_id, 0, '', 0 from convs),
        lens as (select conv_id, max(d) n from paths group by 1),
        nodes as (select k, d, min(p.conv_id) conv_id, any_value(chars) chars, count(*) n_convs,
                         sha256(coalesce(string_agg(p.conv_id::varchar, ',' order by p.conv_id) filter (where lens.n = d), '')) ends_sha256
                  from paths p join lens using (conv_id) group by k, d),
        kids as (select a.k, a.d, count(b.k) n_children, any_value(b.k) from nodes a
                 left join nodes b on b.d = a.d + 1 and left(b.k, 32 * a.d::int) = a.k group by a.k, a.d),
        up as (select left(b.k, 32 * u::int) k, count(*) filter (where n_children = 0) n_leaves,
                      sum((n_convs - 1) * chars)::bigint saved_tokens
               from (select *, unnest(range(0, d + 1)) u from nodes join kids using (k, d)) b group by 1)
        select a.conv_id, a.d depth, parent.conv_id parent_conv_id, a.n_convs, n_children, n_leaves, saved_tokens, a.ends_sha256
        from nodes a join kids using (k, d) join up using (k)
        left join nodes parent on parent.d = a.d - 1 and parent.k = left(a.k, 32 * (a.d::int - 1)) and a.d > 0""",
    "op8_decontamination": r"""
        with d as (select doc_id, regexp_extract_all({d}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') ws from documents),
        b as (select item_id, regexp_extract_all({d}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') ws from benchmark),
        bw as (select item_id, ws, least(10, len(ws)) m from b where len(ws) > 0),
        win as (select distinct item_id, m, array_to_string(ws[i : i + m - 1], ' ') g
                from (select item_id, ws, m, unnest(range(1, len(ws) - m + 2)) i from bw)),
        sizes as (select distinct m from win),
        grams as (select doc_id, m, i, array_to_string(ws[i : i + m - 1], ' ') g
                  from (select doc_id, ws, m, unnest(range(1, len(ws) - m + 2)) i from d, sizes where len(ws) >= m)),
        occ as (select doc_id, i, grams.m, item_id from grams join win on grams.m = win.m and grams.g = win.g),
        hits as (select doc_id, count(distinct p) n from (select doc_id, unnest(range(i, i + m)) p from occ) group by 1),
        its as (select doc_id, count(*) n, string_agg(x, ',' order by x) ids
                from (select distinct doc_id, item_id::varchar x from occ) group by 1)
        select d.doc_id, len(ws) n_words, coalesce(hits.n, 0) n_hit, coalesce(its.n, 0) n_items,
               sha256(coalesce(ids, '')) items_sha256, hits.n is not null contaminated
        from d left join hits using (doc_id) left join its using (doc_id)""".replace("{d}", LOWER.format("text")),
}
