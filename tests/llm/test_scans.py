"""License scan, URL filter, decontamination, token counts, SentencePiece."""

import hashlib
import random
from collections import Counter

import brute
import public_tokenizers
import pytest
import sentencepiece

from tidewatch.llm import decontaminate, license_scan, sentencepieces, token_counts, url_filter
from tidewatch.llm.texts import LETTERS, NOT_BLANK, Words

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def by_id(rows, *names):
    return Counter(tuple(r[n] for n in names) for r in rows)


def test_words_and_hashes():
    texts = ["Ab-é  x9", "", "ÀB ab\x85c", " \tA\nb\x0b"]
    for letters, plain in ((LETTERS, brute.words), (NOT_BLANK, lambda t: brute.BLANK.findall(brute.fold(t)))):
        found = Words.of([t.encode() for t in texts], letters)
        got = [[found.word(i).decode() for i in range(a, b)] for a, b in zip(found.bounds, found.bounds[1:])]
        assert got == [plain(t) for t in texts]
        known = {}
        for i, value in enumerate(found.hashes().tolist()):
            assert known.setdefault(value, found.word(i)) == found.word(i)
        assert len(known) == len({found.word(i) for i in range(len(found))})


@pytest.mark.parametrize("which", ["odd", "corpus"])
def test_license_scan(frame, which, request):
    rows = request.getfixturevalue(which) + [
        (100, "by cc by cc by"), (101, "Released under the MIT\nLicense."), (102, "x " * 64 + "licensed under cc by nc 4.0 " + "y " * 90),
        (103, "general public. license all rights x reserved"),
    ]
    got = license_scan.license_scan(frame(rows)).collect()
    want = Counter()
    for i, text in rows:
        places = brute.phrase_places(text, license_scan.BASE_PHRASES)
        flat = [p for x in places.values() for p in x]
        more = brute.template_matches(text, license_scan.TEMPLATES, license_scan.CONTAINMENT, license_scan.STEP)
        want[i, len(brute.words(text)), len(flat), min(flat, default=None), max(flat, default=None),
             ",".join(sorted(places)), ",".join(sorted({*places, *more}))] += 1
    assert by_id(got, "id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels") == want
    assert all(0 <= r["score"] <= 1 and (r["score"] == 1) >= bool(r["base_labels"]) for r in got)


def test_license_scan_of_nothing(frame):
    assert license_scan.license_scan(frame([])).collect() == []


def test_license_templates_of_any_length(frame):
    """Whole licence texts beside one-line notices, against all blocks of each."""
    rng = random.Random(5)
    pool = [f"w{i}" for i in range(900)]
    templates = {f"t{n}": " ".join(rng.choice(pool) for _ in range(n)) for n in (3, 64, 65, 66, 160, 1500)}
    rows = []
    for i, (name, text) in enumerate(templates.items()):
        own = text.split()
        lost = own[: len(own) - len(own) // 20]  # nineteen of twenty words
        noise = [f"x{k}" for k in range(rng.randint(0, 300))]
        rows += [(10 * i, " ".join(noise + own + noise)), (10 * i + 1, " ".join(noise + lost)), (10 * i + 2, " ".join(own[: len(own) // 2]))]
    got = license_scan.license_scan(frame(rows), templates, {}).collect()
    for r in got:
        text = dict(rows)[r["id"]]
        want = set()
        for name, template in templates.items():
            want |= brute.template_matches(text, {name: template}, 0.9, license_scan.step_of(len(template.split())))
        assert set(filter(None, r["labels"].split(","))) == want
        if r["id"] % 10 == 0:
            assert list(templates)[r["id"] // 10] in want


def url_rows():
    return [
        (1, None), (2, "no scheme"), (3, "http://A.Example.COM/en/x?q#f"), (4, "https://www.example.com/en/"), (5, "x://net/es/a"),
        (6, "x://a.net/fr/"), (7, "x://anet/fr/"), (8, "x://com"), (9, "x://com?/"), (10, "x://com/"), (11, ""), (12, "://"),
        (13, "a://b.com/x://net/es/"), (14, "x://example.com/en"), (None, "x://net/es/"), (5, "x://net/es/a"), (15, "x://../"),
    ]


def plain_rule(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = brute.fold(rest.translate(str.maketrans("?#", "//")).split("/")[0])
    path = rest[len(host):].replace("#", "?").split("?")[0]
    fit = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=(0, None, "allow"))
    return host, path, best[1], best[2]


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_url_filter(spark, limit):
    rules = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]
    listed = spark.createDataFrame([*rules, (None, "/", "block")], "host string, path string, verdict string")
    pages = spark.createDataFrame([(i, u, "h") for i, u in url_rows()], "page_id bigint, url string, host string").repartition(2)
    got = url_filter.url_filter(pages, listed, max_list_bytes=limit).collect()
    assert by_id(got, "id", "host", "path", "rule", "verdict") == Counter((i, *plain_rule(u, rules)) for i, u in url_rows())
    assert url_filter.url_filter(pages.limit(0), listed, max_list_bytes=limit).collect() == []


def test_colliding_digests_are_told_apart(tmp_path, monkeypatch):
    monkeypatch.setattr(url_filter.xxhash, "xxh64_intdigest", lambda x, *a: len(x))
    url_filter.DigestArray.write([(b"a.b/", 1, True), (b"c.d/", 1, False), (b"c.e/", 1, True)], str(tmp_path / "d"))
    array = url_filter.DigestArray.open(str(tmp_path / "d"))
    rules, blocks = array.longest([b"c.d", b"x.y", b"a.b"], [b"/q", b"/", b"/"])
    assert rules == [b"c.d/", None, b"a.b/"] and blocks == [False, False, True]


ITEMS = [
    (1, "the quick brown fox jumps over the lazy dog and then it sleeps"), (2, "short item"), (3, "one"), (4, None), (5, "... !"),
    (12, "jumps over the lazy dog and then it sleeps well tonight under stars"), (7, "a b a b a b a b a b a b a b"), (2, "short item"),
]


@pytest.mark.parametrize("groups", [1_000_000, 5])
def test_contamination(spark, frame, odd, monkeypatch, groups):
    monkeypatch.setattr(decontaminate, "WORDS_PER_AUTOMATON", groups)
    rows = odd + [
        (20, "x the QUICK brown fox jumps over the lazy dog, and y"), (21, "the quick brown fox jumps over the lazy dog"),
        (22, "a short-item and one"), (23, "b a b a b a b a b a b a b a b c short"), (24, "item short"),
        (25, " ".join(x for x in ITEMS[0][1].split()) + " well tonight"), (26, "one one"),
    ]
    bench = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    got = decontaminate.contamination(frame(rows), bench).collect()
    want = Counter()
    for i, text in rows:
        n, hit, who = brute.contamination(text, ITEMS, decontaminate.WINDOW)
        want[i, n, hit, len(who), hashlib.sha256(",".join(who).encode()).hexdigest()] += 1
    assert by_id(got, "id", "n_words", "n_hit", "n_items", "items_sha256") == want


def test_random_contamination(spark, frame):
    choose = random.Random(4)
    items = [(i, " ".join(choose.choices("abc", k=choose.randint(1, 16)))) for i in range(12) if i != 3]
    rows = [(i, " ".join(choose.choices("abcd", k=choose.randint(0, 40)))) for i in range(150)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    for window in (4, 10):
        for r in decontaminate.contamination(frame(rows), bench, window).collect():
            n, hit, who = brute.contamination(rows[r["id"]][1], items, window)
            assert (r["n_words"], r["n_hit"], r["items"]) == (n, hit, who)


def test_decontaminated(spark, frame, odd):
    bench = spark.createDataFrame(ITEMS[:1], "item_id bigint, text string")
    rows = odd + [(30, "Keep this, " + ITEMS[0][1].upper() + "; and this. And some more words to keep here today ok"), (31, ITEMS[0][1])]
    got = decontaminate.decontaminated(frame(rows), bench)
    assert got.columns == frame(rows).columns
    texts = {r["doc_id"]: r["text"] for r in got.collect() if r["doc_id"] is not None}
    assert texts[30] == "Keep this, ; and this. And some more words to keep here today ok" and 31 not in texts
    assert all(texts[i] == t for i, t in odd if i is not None)
    assert decontaminate.decontaminated(frame(rows), bench.limit(0)).count() == len(rows)


def strange_texts():
    choose = random.Random(1)
    letters = " \n\taaabbée▁.,the12漢字😀 \u3000\x00<>s/"
    return ["".join(choose.choice(letters) for _ in range(choose.randint(0, 60))) for _ in range(1500)]


def test_token_counts(frame, odd, corpus):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rows = odd + [(i + 1000, t) for i, t in corpus[:60]] + [(i + 5000, t) for i, t in enumerate(strange_texts())]
    got = token_counts.token_counts(frame(rows), MODEL).collect()
    want = Counter((i, len((t or "").encode()), len(library.encode(t or ""))) for i, t in rows)
    assert by_id(got, "id", "n_bytes", "n_tokens") == want
    assert token_counts.token_counts(frame([]), MODEL).collect() == []


def test_token_count_caches_are_bounded(monkeypatch):
    monkeypatch.setattr(token_counts, "CACHE_ROWS", 3)
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    lengths = token_counts.Lengths({}, MODEL)
    cut = token_counts.pattern(MODEL)
    for text in strange_texts()[:100]:
        assert sum(map(lengths.__getitem__, token_counts.pre_tokens(text.encode(), cut))) == len(library.encode(text))
        assert len(lengths.cache) <= 3


def test_sentencepieces_match_the_library():
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    pieces, cut = sentencepieces.loaded(MODEL)
    for text in [*strange_texts(), "!" * 99, "ab" * 80, "aab" * 50, "\n" * 9, " " * 40]:
        ids = sentencepieces.text_ids(text.encode(), pieces, cut).tolist()
        assert ids == library.encode(text)
        assert pieces.decoded(ids).decode() == text.replace("▁", " ")


def test_unigram_ways_have_the_highest_sum():
    pieces = sentencepieces.Pieces(sentencepieces.UNIGRAM, {"a": 0, "b": 1, "ab": 2, "ba": 3, "bab": 4}, [-1.0, -1.5, -1.2, -2.0, -1.9],
                                   [b"a", b"b", b"ab", b"ba", b"bab"], [0] * 256, unknown=-10.0)
    pieces._build()

    def best(text):
        if not text:
            return 0.0
        ends = [best(text[: -len(p)]) + pieces.scores[i] for p, i in pieces.ids.items() if text.endswith(p)]
        return max(ends, default=best(text[:-1]) - 10.0)

    for text in ("abab", "babab", "aabbab", "abxab", "bba"):
        ways = pieces.ways(text)
        assert "".join(ways) == text
        assert sum(pieces.scores[pieces.ids[w]] if w in pieces.ids else -10.0 for w in ways) == pytest.approx(best(text))


def test_encoding_frames(frame, odd):
    coded = sentencepieces.with_ids(frame(odd), MODEL)
    assert coded.columns == [*frame(odd).columns, "token_ids"]
    back = sentencepieces.with_text(coded, MODEL)
    want = Counter((i, (t or "").replace("▁", " ")) for i, t in odd)
    assert by_id(back.collect(), "doc_id", "text") == want
    trips = sentencepieces.round_trips(frame(odd), MODEL).collect()
    assert all(r["round_trip"] for r in trips) and len(trips) == len(odd)
    assert sentencepieces.with_ids(frame([]), MODEL).collect() == []


def test_contamination_by_items_without_id(spark, frame):
    """Items without an id are one item more, also where another has the same text."""
    long, short = " ".join(f"w{i}" for i in range(14)), "three short words"
    rows = [(1, f"x {long} y"), (2, f"{short} and"), (3, f"{short} {long}"), (4, "clean"), (5, None)]
    for known, names in (([7], ["7"]), ([], []), ([None], []), ([7, 9, None], ["7", "9"])):
        ids = [None, *known]
        items = [(i, text) for i in ids for text in (long, short)]
        benchmark = spark.createDataFrame(items, "item_id bigint, text string")
        got = {r["id"]: r for r in decontaminate.contamination(frame(rows), benchmark).collect()}
        want = {1: 14, 2: 3, 3: 17, 4: 0, 5: 0}
        assert {i: r["n_hit"] for i, r in got.items()} == want
        for i, hit in want.items():
            own = names if hit else []
            assert got[i]["n_items"] == (len(own) + 1 if hit else 0)
            assert got[i]["items"] == own
            assert got[i]["items_sha256"] == hashlib.sha256(",".join(own).encode()).hexdigest()


def test_contamination_of_nothing(spark, frame):
    benchmark = spark.createDataFrame([(1, "one two three")], "item_id bigint, text string")
    assert decontaminate.contamination(frame([]), benchmark).collect() == []
    assert decontaminate.decontaminated(frame([]), benchmark).collect() == []
