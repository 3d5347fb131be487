import hashlib
import random
import zlib

from pyspark.sql import functions as F

from kinweave.llm import queries, spotsigs, warc


def spots(text):
    import re

    words = [w for w in re.split(r"[^\w]+|_", text.lower()) if w]
    marked = ["#^"] + ["#" + w if w in spotsigs.ANCHORS else w for w in words]
    content = [i for i, w in enumerate(marked) if not w.startswith("#")]
    out = set()
    for i, w in enumerate(marked):
        after = [marked[j] for j in content if j > i][:2]
        own = not w.startswith("#") and zlib.crc32(w.encode()) % spotsigs.OWN_ANCHORS == 0
        if (w.startswith("#") or own) and len(after) == 2:
            out.add(("~" * own + w, *after))
    return out if len(out) > 1 else out | {("whole", " ".join(words) or text)}


def likeness(a, b):
    return len(a & b) / len(a | b)


def test_op6_against_plain_python(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    ids = sorted(docs)
    rows = {r.doc_id: r for r in queries.op6_spotsigs(spark, sf).collect()}
    assert sorted(rows) == ids
    for i, following in zip(ids, ids[1:] + ids[:1]):
        text, other, r = docs[i], docs[following], rows[i]
        half = len(text) // 2
        edited = text[: len(text) - half] + other[:half]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert abs(r.near_edited - likeness(spots(text), spots(edited))) < 1e-9
        assert abs(r.near_next - likeness(spots(text), spots(other))) < 1e-9
    by_text = {}
    for i in ids:
        assert by_text.setdefault(docs[i], rows[i].fingerprint) == rows[i].fingerprint


def test_next_rows_over_buckets(spark):
    rows = [(i * i, f"text {i}", 1) for i in range(50)] + [(None, None, 1), (None, "b", 1), (49, "a twin", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, spots int")
    found = spotsigs.with_next(df, rows_per_bucket=4).collect()
    order = sorted(((r[0] if r[0] is not None else -1, r[1] or "") for r in rows))
    want = {a: b for a, b in zip(order, order[1:] + order[:1])}
    got = {(r.id if r.id is not None else -1, r.text): r.next_text for r in found}
    assert len(found) == len(rows) and got == {k: v[1] for k, v in want.items()}
    assert spotsigs.with_next(df.limit(0)).count() == 0
    alone = spotsigs.with_next(df.limit(1)).collect()
    assert alone[0].next_text == alone[0].text


def test_odd_texts(spark):
    texts = ["", "!!", "?", "the of", "word", "the the " * 20_000, "a cat sat", "A cat SAT!", None, "The cat sat on the mat and the dog ran"]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id int, text string, fingerprint string")
    got = [r.fingerprint for r in spotsigs.fingerprints(df).orderBy("doc_id").collect()]
    assert all(got) and got[0] == got[8] and got[6] == got[7] and len(set(got[:7])) == 7
    assert spotsigs.fingerprints(df.limit(0)).count() == 0


def test_texts_without_listed_words(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("bcdgklmprstvz", k=6))
    long_ = [" ".join(["onno", "bokko"] + [word() for _ in range(n)]) for n in (400, 400, 12, 12)]
    half = [t[: len(t) // 2] + " " + " ".join(word() for _ in range(200)) for t in long_[:1]]
    df = spark.createDataFrame(list(enumerate(long_ + half)), "doc_id int, text string")
    sets = {r.doc_id: set(r.spots) for r in spotsigs.fingerprints(df).collect()}
    assert likeness(sets[0], sets[1]) < 0.05 and likeness(sets[2], sets[3]) <= 0.34
    assert 0.2 < likeness(sets[0], sets[4]) < 0.5 and len(sets[0]) > 60


def test_near_pairs_against_brute_force(spark, sf):
    prints = spotsigs.fingerprints(spark.read.parquet(f"{sf}/documents.parquet"))
    rows = {r.doc_id: frozenset(r.spots) for r in prints.collect()}
    first = {}
    for i in sorted(rows):
        first.setdefault(rows[i], i)
    members, pairs = spotsigs.near_pairs(prints, 0.6)
    assert {r.doc_id: r.class_id for r in members.collect()} == {i: first[s] for i, s in rows.items()}
    heads = sorted(first.values())
    want = {(a, b) for a in heads for b in heads if a < b and likeness(rows[a], rows[b]) >= 0.6}
    assert {(r.class_a, r.class_b) for r in pairs.collect()} == want


def test_native_plan(spark, sf):
    plan = queries.op6_spotsigs(spark, sf)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "MapInArrow"))


def test_canonical_urls(spark):
    given = ["HTTP://WWW.Ex.org:80/a/b/#top", "https://ex.org/a/b?utm_source=f", "ex.org/a/b?z=1&a=2", "https://ex.org/a/b/?a=2&z=1&utm_x=1", None, ""]
    df = spark.createDataFrame([(u,) for u in given], "u string")
    assert [r[0] for r in df.select(warc.canonical_url(F.col("u"))).collect()] == ["ex.org/a/b", "ex.org/a/b", "ex.org/a/b?a=2&z=1", "ex.org/a/b?a=2&z=1", None, ""]


def record(i, kind, url, at, payload=None, **headers):
    return (i, kind, url, at, {k.replace("_", "-"): v for k, v in headers.items()} or None, payload, "clash")


def test_revisits(spark):
    rows = [
        record(1, "response", "http://a.org/x", 10, "one", etag='"e1"', content_type="t", date="d1"),
        record(2, "response", "https://www.a.org/x/", 20, "two", etag='"e2"', last_modified="m2", content_length="3"),
        record(3, "response", "http://a.org/x", 20, "three", etag='"e3"', content_length="5", date="old"),
        record(11, "revisit", "http://a.org/x", 10, None, etag='"e1"'),
        record(12, "revisit", "http://a.org/x", 15, None, etag='W/"e1"', date="new", content_length="0", server="s"),
        record(13, "revisit", "http://a.org/x#f", 30, None, etag='"e2"'),
        record(14, "revisit", "http://a.org/x", 30, None, date="new"),
        record(15, "revisit", None, 30), record(16, "revisit", "http://a.org/x", None), record(17, None, "http://a.org/x", 40), record(18, "revisit", "http://b.org/", 40),
        record(14, "revisit", "http://a.org/x", 30, None, date="new"), record(None, "response", "http://b.org/", 1, "lost"),
    ]
    df = spark.createDataFrame(rows, "record_id long, kind string, url string, captured long, headers map<string,string>, payload string, verdict string")
    got = sorted((r.record_id, r.refers_to, r.verdict, r.payload, tuple(sorted((r.headers or {}).items()))) for r in warc.resolve_revisits(df).collect())
    assert got == [
        (11, None, "missing", None, (("etag", '"e1"'),)),
        (12, 1, "valid", "one", (("content-type", "t"), ("date", "new"), ("etag", 'W/"e1"'))),
        (13, 3, "mismatch", None, (("etag", '"e2"'),)),
        (14, 3, "unchecked", "three", (("content-length", "5"), ("date", "new"), ("etag", '"e3"'))),
        (14, 3, "unchecked", "three", (("content-length", "5"), ("date", "new"), ("etag", '"e3"'))),
        (15, None, "missing", None, ()), (16, None, "missing", None, ()), (18, None, "missing", None, ()),
    ]
    assert warc.resolve_revisits(df.limit(0)).count() == 0


def test_one_hot_url_over_spans(spark):
    rows = [record(i, "response" if i % 3 else "revisit", "http://hot.org/", i * 7 % 501, "p", etag='"x"') for i in range(500)]
    df = spark.createDataFrame(rows, "record_id long, kind string, url string, captured long, headers map<string,string>, payload string, x string")
    full = [(r[3], r[0]) for r in rows if r[1] == "response"]
    want = {r[0]: max((f for f in full if f[0] < r[3]), default=(None, None))[1] for r in rows if r[1] == "revisit"}
    assert {r.record_id: r.refers_to for r in warc.resolve_revisits(df).collect()} == want


def test_revisits_that_share_an_id_or_have_none(spark):
    rows = [
        record(1, "response", "http://a.org/x", 10, "one", etag='"e1"'), record(1, "response", "http://b.org/x", 10, "other", etag='"e9"'),
        record(None, "revisit", "http://a.org/x", 20, None, etag='"e1"'), record(None, "revisit", "http://a.org/x", 20, None, etag='"e2"'),
        record(7, "revisit", "http://a.org/x", 30, None, etag='"e3"'), record(7, "revisit", "http://b.org/x", 30, None, etag='"e9"'),
    ]
    df = spark.createDataFrame(rows, "record_id long, kind string, url string, captured long, headers map<string,string>, payload string, x string")
    got = sorted((r.record_id or 0, r.canonical, r.headers["etag"], r.verdict, r.payload or "") for r in warc.resolve_revisits(df).collect())
    assert got == [
        (0, "a.org/x", '"e1"', "valid", "one"), (0, "a.org/x", '"e2"', "mismatch", ""),
        (7, "a.org/x", '"e3"', "mismatch", ""), (7, "b.org/x", '"e9"', "valid", "other"),
    ]
