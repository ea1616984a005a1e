"""DuckDB SQL for every registered query that SQL can state."""

from __future__ import annotations

from checks.inputs import CUTOFF, FIRST_RUN, KEYWORDS, LEXICON, MODIFIERS

# The input views and the tables derived from them, in order.
_VIEWS = f"""
mx as (select max(doc_id) mx from documents),
times as (select event_id doc_id, cast(epoch_us(ts) // 1000000 as double) created_utc from events),
convs as (select c.*, mx - conv_id doc_id from conversations c, mx),
posts as (
  select d.source subreddit_name, cast(d.doc_id as varchar) id, t.created_utc,
    cast(coalesce(n.n, 0) as int) num_comments, (d.doc_id % 101) / 100.0::double upvote_ratio,
    split_part(d.text, chr(10), 1) title, d.text selftext,
    '/r/' || d.source || '/comments/' || d.doc_id || '/' permalink, d.doc_id
  from documents d join times t using (doc_id)
  left join (select doc_id, count(*) n from convs group by 1) n on n.doc_id = d.doc_id),
posts_t0 as (select * from posts where created_utc <= {FIRST_RUN}),
raw_comments as (
  select p.id submission_id, 'c' || c.conv_id || '_' || c.turn comment_id,
    case when (c.conv_id + c.turn) % 11 = 0 then '[deleted]'
         when (c.conv_id + c.turn) % 13 = 0 then null else c.text end body,
    cast(c.turn - 2 as int) score, p.permalink || c.turn || '/' permalink,
    p.created_utc + (c.turn + 1) * 1800.0::double created_utc
  from convs c join posts p using (doc_id)),
raw_comments_t0 as (select * from raw_comments where created_utc <= {FIRST_RUN}),
kw as (select unnest({KEYWORDS}) keyword),
subs as (select 'src' || i subreddit from range(20) r(i) union all select 'nosuch'),
lexicon as (select unnest({list(LEXICON)}) word, unnest({list(LEXICON.values())})::double polarity),
newest as (
  select p.*, row_number() over (partition by subreddit_name order by created_utc desc, id) rn
  from posts p where subreddit_name in (select subreddit from subs)),
newest_t0 as (
  select p.*, row_number() over (partition by subreddit_name order by created_utc desc, id) rn
  from posts_t0 p where subreddit_name in (select subreddit from subs)),
submissions as (
  select subreddit_name, keyword "key", title post_title, id, permalink PermaLink, num_comments Comments,
    selftext Self_text, created_utc time_utc, upvote_ratio
  from newest join kw on contains(lower(title), lower(keyword)) or contains(lower(selftext), lower(keyword))
  where rn <= 500 and created_utc > {CUTOFF}),
submissions_t0 as (
  select subreddit_name, keyword "key", title post_title, id, permalink PermaLink, num_comments Comments,
    selftext Self_text, created_utc time_utc, upvote_ratio
  from newest_t0 join kw on contains(lower(title), lower(keyword)) or contains(lower(selftext), lower(keyword))
  where rn <= 500 and created_utc > {CUTOFF}),
incr as (
  select subreddit_name, keyword "key", title post_title, id, permalink PermaLink, num_comments Comments,
    selftext Self_text, created_utc time_utc, upvote_ratio
  from newest join kw on contains(lower(title), lower(keyword)) or contains(lower(selftext), lower(keyword))
  where rn <= 500 and created_utc > (select max(time_utc) from submissions_t0)),
merged as (select * from submissions_t0 union all select * from incr),
"""


def _comments(suffix: str, submissions: str, newest: str, comments: str) -> str:
    """Bronze to gold comments over the named views."""
    return f"""
direct{suffix} as (
  select s.id submission_id, c.comment_id, 'N/A' keyword, c.body comment_body, c.score, c.permalink,
    c.created_utc time_utc
  from {submissions} s join {comments} c on c.submission_id = s.id),
indirect{suffix} as (
  select c.submission_id, c.comment_id, kw.keyword, c.body comment_body, c.score, c.permalink,
    c.created_utc time_utc
  from {newest} n join {comments} c on c.submission_id = n.id
  join kw on contains(lower(c.body), lower(kw.keyword))
  where n.rn <= 200 and c.created_utc > {CUTOFF}),
union{suffix} as (select * from direct{suffix} union all select * from indirect{suffix}),
dedup{suffix} as (
  select * exclude (rn) from (
    select u.*, row_number() over (partition by comment_id order by time_utc desc,
      case when keyword = 'N/A' then 1 else 0 end, keyword, score desc) rn
    from union{suffix} u) z
  where rn = 1),
clean{suffix} as (select * from dedup{suffix} where not contains(comment_body, '[deleted]')),
"""


def _utc(column: str) -> str:
    return f"to_timestamp(cast(trunc({column}) as bigint)) at time zone 'UTC'"


def _times(column: str) -> str:
    utc = _utc(column)
    return (
        f"strftime({utc}, '%Y-%m-%d %H:%M:%S') time_utc, "
        f"timezone('America/New_York', timezone('UTC', {utc})) time_est"
    )


def _silver(suffix: str, submissions: str) -> str:
    return f"""
silver_comments{suffix} as (
  select submission_id, comment_id, keyword, comment_body, score,
    'https://www.reddit.com' || permalink "URL", {_times('time_utc')} from clean{suffix}),
silver_submissions{suffix} as (
  select subreddit_name, "key", post_title, id, Comments, Self_text, upvote_ratio,
    'https://www.reddit.com' || PermaLink "URL", {_times('time_utc')} from {submissions}),
"""


def _score(text: str) -> str:
    """Mean polarity in whole billionths, as the library sums it."""
    hits = (
        f"select unnest(regexp_extract_all(lower({text}), '\\p{{L}}+')) word"
    )
    return f"""case when {text} is not null then coalesce((
      select round(sum(cast(round(l.polarity * 1e9) as bigint)) / cast(count(*) * 1000000000 as double), 6)
      from ({hits}) w join lexicon l using (word)), 0.0) + 0.0 end"""


_GOLD = """
gold_comments{s} as (select *, {c} comment_sentiment from silver_comments{s}),
gold_submissions{s} as (select *, {t} title_sentiment from silver_submissions{s}),
"""

_NOW = _comments("_now", "submissions", "newest", "raw_comments") + _silver("_now", "submissions")
# As two runs leave the tables: submissions merged, comments made again.
_RUN = _comments("_run", "merged", "newest", "raw_comments") + _silver("_run", "merged")
_T0 = _comments("_t0", "submissions_t0", "newest_t0", "raw_comments_t0")
_ALL = "".join(
    [_VIEWS, _NOW, _RUN, _T0]
    + [_GOLD.format(s=s, c=_score("comment_body"), t=_score("post_title")) for s in ("_now", "_run")]
)


def _sql(select: str) -> str:
    return f"with {_ALL.rstrip().rstrip(',')}\n{select}"


_FLAGS = f"""(
  select p.subreddit_name, d.lang,
    count(*) filter (created_utc <= {CUTOFF}) > 0 table_exists,
    count(*) filter (l.toxic = 1) = 0 both_same,
    count(*) filter (created_utc > {CUTOFF} and created_utc <= {FIRST_RUN}) stored_rows,
    count(*) filter (created_utc > {FIRST_RUN}) new_rows
  from posts p join documents d using (doc_id) left join labels l using (doc_id)
  group by 1, 2)"""

_OLD = f"select subreddit_name from posts where created_utc <= {FIRST_RUN}"
_NEW = "select subreddit_name from posts"

# Target types of the two synced tables, by the wide and by the original map.
_TYPES = {
    ("submissions", False): [
        ("subreddit_name", "NVARCHAR(MAX)"), ("keyword", "NVARCHAR(MAX)"), ("post_title", "NVARCHAR(MAX)"),
        ("id", "NVARCHAR(MAX)"), ("Comments", "INT"), ("Self_text", "NVARCHAR(MAX)"),
        ("time_utc", "NVARCHAR(MAX)"), ("upvote_ratio", "FLOAT"), ("URL", "NVARCHAR(MAX)"),
        ("time_est", "DATETIME2"), ("title_sentiment", "REAL"),
    ],
    ("submissions", True): [
        ("subreddit_name", "NVARCHAR(255)"), ("keyword", "NVARCHAR(255)"), ("post_title", "NVARCHAR(255)"),
        ("id", "NVARCHAR(255)"), ("Comments", "INT"), ("Self_text", "NVARCHAR(255)"),
        ("time_utc", "NVARCHAR(255)"), ("upvote_ratio", "FLOAT"), ("URL", "NVARCHAR(255)"),
        ("time_est", "NVARCHAR(255)"), ("title_sentiment", "NVARCHAR(255)"),
    ],
    ("comments", False): [
        ("submission_id", "NVARCHAR(MAX)"), ("comment_id", "NVARCHAR(MAX)"), ("keyword", "NVARCHAR(MAX)"),
        ("comment_body", "NVARCHAR(MAX)"), ("score", "INT"), ("time_utc", "NVARCHAR(MAX)"),
        ("URL", "NVARCHAR(MAX)"), ("time_est", "DATETIME2"), ("comment_sentiment", "REAL"),
    ],
    ("comments", True): [
        ("submission_id", "NVARCHAR(255)"), ("comment_id", "NVARCHAR(255)"), ("keyword", "NVARCHAR(255)"),
        ("comment_body", "NVARCHAR(255)"), ("score", "INT"), ("time_utc", "NVARCHAR(255)"),
        ("URL", "NVARCHAR(255)"), ("time_est", "NVARCHAR(255)"), ("comment_sentiment", "NVARCHAR(255)"),
    ],
}
_NO_TEXT = {"Comments", "upvote_ratio", "time_est", "title_sentiment", "score", "comment_sentiment"}


def _type_rows() -> str:
    parts = []
    for (table, compat), columns in _TYPES.items():
        for position, (name, kind) in enumerate(columns):
            stored = "key" if (table, name) == ("submissions", "keyword") else name
            longest = "cast(max(null) as int)" if name in _NO_TEXT else f'cast(max(length("{stored}")) as int)'
            parts.append(
                f"select '{table}' table_name, {position} \"position\", '{name}' column_name, "
                f"'{kind}' sql_type, {longest} max_chars, {str(compat).lower()} compat from gold_{table}_run"
            )
    return "\nunion all ".join(parts)


def _escaped(column: str) -> str:
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        column = f"replace({column}, '{raw}', '{entity}')"
    return column


_COUNTS = """counts as (
  select greatest((select count(*) from merged) - (select count(*) from submissions_t0), 0) n_posts,
    greatest((select count(*) from indirect_run) - (select count(*) from indirect_t0), 0) n_comments),
lines as (
  select 0 section, time_utc, id tie, "key" tie2, {p} line, row_number() over (
    order by time_utc desc, id, "key") rn, (select n_posts from counts) k from merged
  union all
  select 1, time_utc, comment_id, keyword, {c}, row_number() over (
    order by time_utc desc, comment_id, keyword), (select n_comments from counts) from indirect_run),
chosen as (select * from lines where rn <= k)
""".format(p=_escaped("post_title"), c=_escaped("comment_body"))


def _digest(select: str) -> str:
    return f"with {_ALL}\n{_COUNTS}\n{select}"


_RECIPIENT = "select 'user' || user_id || '@example.org' recipient from events order by event_id limit 1"
# Lines of a digest page.
_PAGE = 1000

def _newest_lines(time: str) -> str:
    return f"""select l_orderkey, l_linenumber, {time} time_utc from lineitem
      order by time_utc desc, l_orderkey, l_linenumber limit 20000"""


ORACLE_SQL: dict[str, str] = {
    "scan_config_list": "select source subreddits, count(*) n from documents group by 1",
    "config_diff": _sql(
        f"select subreddit_name subreddits, 'old' side from (({_OLD}) except all ({_NEW})) "
        f"union all select subreddit_name, 'new' from (({_NEW}) except all ({_OLD}))"
    ),
    "config_diff_flags": _sql(
        f"""select same_sub, same_key, same_sub and same_key both_same from (select
          not exists (({_OLD}) except all ({_NEW})) and not exists (({_NEW}) except all ({_OLD})) same_sub,
          not exists (select lang from documents except all
            (select lang from documents order by lang desc)) same_key)"""
    ),
    "config_round_trip": """select line, count(*) n, true same_sub from (
      select case when doc_id % 5 = 0 then ' ' || source || '  ' when doc_id % 7 = 0 then ''
        when doc_id % 11 = 0 then null when doc_id % 13 = 0 then source || chr(10) || '"x",y'
        else source end line from documents) group by 1""",
    "config_select": """select d.doc_id, d.source "name" from documents d
      left join (select * from labels where toxic = 1) l using (doc_id)
      where d.source in ('src1', 'src5', 'src9') and l.doc_id is null""",
    "digest_recipient": _RECIPIENT,
    "newest_per_subreddit": _sql(
        "select subreddit_name, id, created_utc, num_comments, upvote_ratio from newest where rn <= 30"
    ),
    "watch_matrix": _sql(
        """select subreddit subreddits, kw.keyword keywords, count(s.id) n from subs cross join kw
        left join submissions s on s.subreddit_name = subreddit and s."key" = kw.keyword group by 1, 2"""
    ),
    "submissions_full": _sql("select * from submissions"),
    "high_water_mark": _sql("select max(time_utc) time_utc from submissions_t0"),
    "submissions_by_day": _sql("select * from incr"),
    "submissions_incremental": _sql("select * from incr"),
    "merge_submissions": _sql(
        """select coalesce(s.subreddit_name, t.subreddit_name) subreddit_name, coalesce(s."key", t."key") "key",
        coalesce(s.post_title, t.post_title) post_title, coalesce(s.id, t.id) id,
        coalesce(s.PermaLink, t.PermaLink) PermaLink, coalesce(s.Comments, t.Comments) Comments,
        coalesce(s.Self_text, t.Self_text) Self_text, coalesce(s.time_utc, t.time_utc) time_utc,
        coalesce(s.upvote_ratio, t.upvote_ratio) upvote_ratio
        from submissions_t0 t full outer join submissions s on s.id = t.id and s."key" = t."key" """
    ),
    "merge_changed": _sql(
        """select coalesce(s.subreddit_name, t.subreddit_name) subreddit_name, coalesce(s."key", t."key") "key",
          case when s.id is null or (t.id is not null and s.id::bigint % 3 <> 0) then t.post_title
               when s.id::bigint % 3 = 0 then s.post_title || '!' else s.post_title end post_title,
          coalesce(s.id, t.id) id, coalesce(s.PermaLink, t.PermaLink) PermaLink,
          coalesce(s.Comments, t.Comments) Comments,
          case when s.id is null or (t.id is not null and s.id::bigint % 3 <> 0) then t.Self_text
               when s.id::bigint % 3 = 1 then null else s.Self_text end Self_text,
          coalesce(s.time_utc, t.time_utc) time_utc, coalesce(s.upvote_ratio, t.upvote_ratio) upvote_ratio
        from submissions_t0 t full outer join submissions s on s.id = t.id and s."key" = t."key" """
    ),
    "submissions_long_keywords": _sql(
        f"""select keyword "key", count(*) n, max(created_utc) latest from newest join (
          select distinct unnest(regexp_extract_all(lower(text), '\\p{{L}}+')) keyword from benchmark
          union all select '') k on contains(lower(title), keyword) or contains(lower(selftext), keyword)
        where rn <= 500 and created_utc > {CUTOFF} group by 1"""
    ),
    "list_rejects": """
        select line, kept, count(*) n from (
          select case when doc_id % 4 = 0 then source || ', ' || lang else source end line, doc_id % 4 <> 0 kept from documents)
        group by 1, 2""",
    "list_fingerprints": _sql(
        f"""select name, not exists(from diff where diff.name = names.name) same
            from (values ('shuffled'), ('added'), ('copied'), ('changed')) names(name)"""
    ).replace("\nselect name", f""",
        lists as (select 'shuffled' as name, 'old' side, lang v from documents
          union all select 'shuffled', 'new', lang from documents
          union all select 'added', 'old', subreddit_name from ({_OLD}) union all select 'added', 'new', subreddit_name from posts
          union all select 'copied', side, source from documents, (values ('old'), ('new')) s(side)
          union all (select 'copied', 'new', source from documents limit 1)
          union all select 'changed', 'old', source from documents
          union all select 'changed', 'new', case when doc_id = 7 then 'other' else source end from documents),
        diff as (select name, v from lists group by 1, 2
          having count(*) filter (side = 'old') <> count(*) filter (side = 'new'))
        select name"""),
    "snapshot_changes": _sql(
        """select coalesce(a.id, b.id) id, coalesce(a."key", b."key") "key",
             case when a.id is null then 'inserted' when b.id is null then 'deleted' else 'updated' end change
           from submissions_t0 a full join (
             select * replace (case when cast(id as bigint) % 3 = 0 then post_title || '!' else post_title end as post_title)
             from submissions where cast(id as bigint) % 5 <> 0) b on a.id = b.id and a."key" = b."key"
           where a.id is null or b.id is null or a is distinct from b"""
    ),
    "stream_submissions": _sql(
        f"""select subreddit_name, keyword "key", title post_title, id, permalink PermaLink, num_comments Comments,
              selftext Self_text, created_utc time_utc, upvote_ratio
            from posts join kw on contains(lower(title), lower(keyword)) or contains(lower(selftext), lower(keyword))
            where subreddit_name in (select subreddit from subs) and created_utc > {CUTOFF}"""
    ),
    "newest_k_large": _newest_lines("cast(date_diff('day', date '1970-01-01', cast(l_shipdate as date)) * 86400 as double)"),
    "newest_k_one_hour": _newest_lines("cast(year(l_shipdate) as double)"),
    "comments_unbounded": _sql("select * from direct_now"),
    "comments_bucketed": _sql("select * from direct_now"),
    "sentiment_long_list": _sql(
        """select comment_id, body, case when body is not null then coalesce((
          select round(sum(cast(l.polarity as bigint) * 1000000000) / cast(count(*) * 1000000000 as double), 6)
          from (select unnest(regexp_extract_all(lower(body), '\\p{L}+')) word) w join (
            select word, (count(*) % 9) - 4 polarity
            from (select unnest(regexp_extract_all(lower(text), '\\p{L}+')) word from documents)
            group by 1 having count(*) >= 10) l using (word)), 0.0) + 0.0 end comment_sentiment
        from raw_comments"""
    ),
    "sentiment_modifiers": _sql(
        f"""select comment_id, body, case when body is not null then coalesce(points, 0.0) + 0.0 end comment_sentiment
        from raw_comments left join (
          select comment_id, round(sum(cast(round(polarity * coalesce(factor, 1.0) * 1e9) as bigint))
            / cast(count(*) * 1000000000 as double), 6) points
          from (select comment_id, ws[i] word, ws[i - 1] before from (
            select comment_id, ws, unnest(range(1, len(ws) + 1)) i from (
              select comment_id, regexp_extract_all(lower(body), '\\p{{L}}+') ws from raw_comments)) x) y
          join lexicon using (word)
          left join (select unnest({list(MODIFIERS)}) before, unnest({[
              (1.0 if strength is None else strength) * (-0.5 if negation else 1.0)
              for negation, strength in MODIFIERS.values()]})::double factor) m using (before)
          group by 1) using (comment_id)"""
    ),
    "write_then_read": _sql("select * exclude (doc_id) from posts"),
    "table_by_name": _sql("select id, subreddit_name, title, created_utc from posts"),
    "comments_direct": _sql("select * from direct_now"),
    "comments_indirect": _sql("select * from indirect_now"),
    "comments_union": _sql("select * from union_now"),
    "comments_dedup": _sql("select * from dedup_now"),
    "comments_clean": _sql("select * from clean_now"),
    "times_utc_local": _sql(f"select id, {_times('created_utc')} from posts"),
    "silver_comments": _sql("select * from silver_comments_now"),
    "silver_incremental": _sql("select * from silver_comments_now"),
    "silver_submissions": _sql("select * from silver_submissions_now"),
    "comment_sentiment": _sql(
        f"select comment_id, body, {_score('body')} comment_sentiment from raw_comments"
    ),
    "title_sentiment": _sql(f"select id, title, {_score('title')} title_sentiment from posts"),
    "gold_comments": _sql("select * from gold_comments_now"),
    "gold_submissions": _sql("select * from gold_submissions_now"),
    "refresh_decision": _sql(
        f"""select *, action = 'merge' updates from (select *, case when not table_exists then 'full'
          when not both_same then 'rebuild' when stored_rows = 0 then 'full'
          when new_rows > 0 then 'merge' else 'keep' end action from {_FLAGS})"""
    ),
    "notify_decision": _sql(
        f"""select *,
          case when same and n > 0 then 'update' when same then 'none'
               when version = 0 then 'first' else 'none' end notify,
          case when same and n > 0 then 'update' when version = 0 then 'first' else 'none' end notify_compat
        from (select subreddit_name, lang, both_same same, new_rows n, least(stored_rows, 2) version
              from {_FLAGS})"""
    ),
    "snapshot_read": _sql("select * from submissions_t0"),
    "snapshot_latest": _sql('select 1::bigint version, id, "key", post_title, time_utc from merged'),
    "snapshot_counts": _sql(
        """select 0::bigint version, count(*) n from submissions_t0
        union all select 1, count(*) from merged"""
    ),
    "snapshot_growth": _sql(
        """select n_curr, n_prev, greatest(n_curr - n_prev, 0) growth from (select
        (select count(*) from indirect_run) n_curr, (select count(*) from indirect_t0) n_prev)"""
    ),
    "snapshot_new_rows": _sql(
        """select comment_id, keyword, time_utc from indirect_run c where not exists (
        select 1 from indirect_t0 p where p.comment_id = c.comment_id and p.keyword = c.keyword)"""
    ),
    "full_run_gold_comments": _sql("select * from gold_comments_run"),
    "full_run_gold_submissions": _sql("select * from gold_submissions_run"),
    "sync_submissions": _sql('select * rename ("key" as keyword) from gold_submissions_run'),
    "sql_type_map": _sql(_type_rows()),
    "digest_posts": _sql(
        'select id, "key", post_title from merged order by time_utc desc, id, "key" limit 100'
    ),
    "digest_comments": _sql(
        "select comment_id, keyword, comment_body from indirect_run "
        "order by time_utc desc, comment_id, keyword limit 100"
    ),
    "digest_lines": _digest("select section, time_utc, line from chosen"),
    "digest_html": _digest(
        f"""select recipient, 'Watch list news' subject, page,
          '<p>To ' || recipient || '</p><p>Since the last digest: ' || n_posts || ' posts, ' || n_comments
          || ' comments.</p><h4>Posts</h4>' || coalesce(posts, '') || '<h4>Comments</h4>' || coalesce(comments, '') html,
          n_posts::bigint post_count, n_comments::bigint comment_count
        from counts, ({_RECIPIENT}),
          (select page, string_agg(line, '<br>' order by rn) filter (section = 0) posts,
                  string_agg(line, '<br>' order by rn) filter (section = 1) comments
           from (select *, (row_number() over (order by section, rn) - 1) // {_PAGE} page from chosen) group by page)"""
    ),
}
