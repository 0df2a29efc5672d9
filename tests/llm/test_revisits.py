import random

from pyspark.sql import functions as F

from tallyforge.llm import revisits as rv

KIND = "record_id bigint, url string, ts double, kind string, headers map<string,string>, digest string"


def test_canonical_urls(spark):
    pairs = {"HTTP://www.Example.com:80/a/?utm_source=x&b=2&a=1#f": "example.com/a?a=1&b=2", "https://example.com": "example.com", "example.com/x//": "example.com/x", "http://m.example.com/?gclid=1": "m.example.com", None: None}
    df = spark.createDataFrame([(k,) for k in pairs], "u string")
    assert [r.c for r in df.select(rv.canonical_url(F.col("u")).alias("c")).collect()] == list(pairs.values())


def brute(rows):
    out = {}
    for i, url, ts, kind, h, _ in rows:
        if kind != "revisit":
            continue
        full = [r for r in rows if r[3] == "response" and r[1] == url and url is not None and ts is not None and r[2] is not None and r[2] < ts]
        best = max(full, key=lambda r: (r[2], r[0]), default=None)
        if best is None:
            out[i] = (None, "orphan", h)
            continue
        a, b = h or {}, best[4] or {}
        if "etag" in a and "etag" in b:
            state = "resolved" if a["etag"].removeprefix("W/") == b["etag"].removeprefix("W/") else "mismatch"
        elif "last-modified" in a and "last-modified" in b:
            state = "resolved" if a["last-modified"] == b["last-modified"] else "mismatch"
        else:
            state = "unchecked"
        merged = {**b, **{k: v for k, v in a.items() if k in rv.PERMITTED}} if state != "mismatch" else a
        out[i] = (best[0], state, merged)
    return out


def test_as_of_join_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(rv, "ROWS_PER_RANGE", 20)
    rng = random.Random(1)
    rows = []
    for i in range(400):
        headers = {k: v for k, v in (("etag", rng.choice(['"1"', 'W/"1"', '"2"'])), ("last-modified", rng.choice("xy")), ("date", str(i)), ("content-length", "5"), ("content-type", "text/html")) if rng.random() < 0.7}
        rows.append((i, rng.choice(["hot.example/"] * 5 + ["a.example/1", "b.example/2", None]), None if rng.random() < 0.03 else float(rng.randrange(300)), rng.choice(["response", "revisit"]), headers or None, f"d{i}"))
    clean = [(i, None if u is None else u.rstrip("/"), *rest) for i, u, *rest in rows]
    out = rv.resolve_revisits(spark.createDataFrame(rows, KIND)).collect()
    got = {r.record_id: (r.response_id, r.state, dict(r.headers)) for r in out}
    want = {k: (a, s, h or {}) for k, (a, s, h) in brute([tuple(r) for r in clean]).items()}
    assert got == want and {s for _, s, _ in want.values()} == {"orphan", "resolved", "mismatch", "unchecked"}
    assert all(r.response_digest == (f"d{r.response_id}" if r.response_id is not None else None) for r in out)


def test_header_names_and_empty(spark):
    rows = [(1, "http://a.example/x", 1.0, "response", {"ETag": '"q"', "Content-Type": "t"}, None), (2, "https://www.a.example/x/", 2.0, "revisit", {"etag": '"q"', "DATE": "d"}, None)]
    out = rv.resolve_revisits(spark.createDataFrame(rows, KIND)).collect()
    assert [(r.response_id, r.state, dict(r.headers)) for r in out] == [(1, "resolved", {"etag": '"q"', "content-type": "t", "date": "d"})]
    assert rv.resolve_revisits(spark.createDataFrame([], KIND)).count() == 0
