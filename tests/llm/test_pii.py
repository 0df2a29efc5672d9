import random
import re

import pytest

from tallyforge.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(s):
    total = 0
    for i, c in enumerate(reversed(s)):
        v = int(c) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base(t):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", m) for m in EMAIL.finditer(t)]
    out += [("ip", m) for m in IP.finditer(t) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [("card", m) for m in CARD.finditer(t) if 16 <= len(digits(m.group())) <= 19 and luhn(digits(m.group()))]
    out += [("phone", m) for m in PHONE.finditer(t) if 8 <= len(digits(m.group())) <= 15]
    return [(k, m.start(), m.end()) for k, m in out]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    rows = [(k, "".join(rng.choice("aZ9.1@-+ %_é🙂20.5()4") for _ in range(rng.randrange(0, 60)))) for k in range(1500)]
    rows.append((2000, "a@b.c_d@e.f a@b.c-d@e.f 1.2.3.4.5.6.7.8 000255.1.1.1 256.1.1.1 4111 1111 1111 1111 4111-1111-1111-1111- +1 (555) 010-9999.. +1-2-3-4-5-6-7-8"))
    rows += [(2001, None), (2002, ""), (2003, "x" * 100_000 + "@"), (2004, "1" * 50_000), (2005, "+1" + "-" * 50_000), (2006, "a.b" * 20_000 + "@c.d"), (None, "me@you.example")]
    return rows


def test_base_spans_are_those_of_python(spark, texts):
    rows = spark.createDataFrame(texts, "doc_id bigint, text string")
    got = {r.doc_id: [(s.kind, s.s, s.e) for s in r.base] for r in pii.personal_data(rows).collect()}
    assert got == {k: base(t or "") for k, t in texts}


def context_corpus(spark):
    """Seeds after ``contact:``, and identifiers that no form matches in the same places."""
    rng = random.Random(8)
    rows = [(k, f"text {rng.random():.0f} word contact: user{k}@mail{k}.example end of it") for k in range(40)]
    rows += [(100 + k, f"other text contact: user{k}[at]mail{k}@internal end of it") for k in range(4)]
    rows += [(200 + k, f"the year {1900 + k}-{k} was good version2 of it") for k in range(40)]
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def test_contexts_find_unseen_identifiers_and_nothing_else(spark):
    rows = {r.doc_id: r for r in pii.personal_data(context_corpus(spark)).collect()}
    for k in range(4):
        spans = rows[100 + k].spans
        assert [(s.kind, s.value) for s in spans] == [("email", f"user{k}[at]mail{k}@internal")] and rows[100 + k].base == []
    for k in range(40):
        assert [s.kind for s in rows[k].spans] == ["email"]
        assert rows[200 + k].spans == []


def brute(edges, rounds):
    """The same rounds over a list of (side, words, value, kind), in plain Python."""
    values, seeds = {}, {(v, k) for _, _, v, k in edges if k}
    for side, words, v, _ in edges:
        values.setdefault((side, words), set()).add(v)
    wanted = {(side, words, v) for side, words, v, k in edges if k in (None, pii.SECRET)}
    known, found, patterns = {x: 1.0 for x in seeds}, {}, {}
    for _ in range(rounds):
        patterns = {}
        for at, there in values.items():
            for kind in {k for _, k in known}:
                support = sum(known.get((v, kind), 0.0) for v in there)
                if len(there) >= pii.LEAST_SUPPORT and support >= pii.LEAST_SUPPORT and support / (len(there) + pii.SMOOTH) >= pii.LEAST_CONFIDENCE:
                    patterns[*at, kind] = support / (len(there) + pii.SMOOTH)
        miss = {}
        for side, words, v in wanted:
            for (a, b, kind), c in patterns.items():
                if (a, b) == (side, words):
                    miss[v, kind] = miss.get((v, kind), 1.0) * (1 - min(c, 0.99))
        found = {}
        for (v, kind), m in miss.items():
            if 1 - m >= pii.LEAST_SCORE:
                found[v] = max(found.get(v, (0, "")), (1 - m, kind))
        known = {x: 1.0 for x in seeds} | {(v, k): c for v, (c, k) in found.items() if v not in {x for x, _ in seeds}}
    return {v: (k, pytest.approx(c)) for v, (c, k) in found.items()}, {k: pytest.approx(c) for k, c in patterns.items()}


@pytest.mark.parametrize("rounds", [1, 2, 3])
def test_rounds_match_brute_force(spark, rounds):
    links = pii.graph(pii.scanned(context_corpus(spark).union(unseen_corpus(spark)))).cache()
    found, patterns = pii.bootstrap(links, rounds)
    want = brute([tuple(e) for e in links.select("side", "words", "value", "kind").collect()], rounds)
    assert {p.value: (p.kind, p.score) for p in found.collect()} == want[0] and want[0]
    assert {(p.side, p.words, p.kind): p.confidence for p in patterns.collect()} == want[1]


def unseen_corpus(spark):
    """Seeds beside marks, and identifiers of other forms: in groups, under other names, in capitals."""
    rng = random.Random(9)
    code = lambda n, of="0123456789abcdef": "".join(rng.choice(of) for _ in range(n))
    rows = [(1000 + k, f'some lines\nkey{chr(97 + k % 3)} = "{code(40)}" and more') for k in range(30)]
    rows += [(1100, 'api_key = "AKIA1234XYZ" there'), (1101, 'PASSWORD = "hunter2x9" there')]
    rows += [(1200 + k, f"please call: +1 555 010 {1000 + k} now") for k in range(30)]
    rows += [(1300, "please call: (030) 123 4567 now"), (1301, "please call: 030 1 2 now")]
    rows += [(1400 + k, f"in chapter {k} we saw {k} of {k + 3} rows") for k in range(30)]
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def test_unseen_forms_are_found(spark):
    rows = {r.doc_id: [(s.kind, s.value) for s in r.spans] for r in pii.personal_data(unseen_corpus(spark)).collect()}
    assert rows[1100] == [("secret", "AKIA1234XYZ")] and rows[1101] == [("secret", "hunter2x9")]
    assert rows[1300] == [("phone", "(030) 123 4567")] and rows[1301] == [("phone", "030 1 2")]
    assert all(len(rows[1000 + k]) == 1 and len(rows[1200 + k]) == 1 and not rows[1400 + k] for k in range(30))


def test_planted_secrets(spark):
    """On the given table, every ``token = "..."`` is found by its context, and nothing else is added."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = {(r.doc_id, m.start(1), m.end(1)) for r in docs.select("doc_id", "text").collect() for m in re.finditer(r'token = "([0-9a-f]{40})"', r.text or "", re.I)}
    got = {(r.doc_id, s.s, s.e) for r in pii.personal_data(docs).collect() for s in r.spans if s not in r.base}
    assert got == want and want


def test_long_text_with_many_matches(spark):
    text = " ".join(f"{k} x{k}@y.z" for k in range(20_000))
    row = pii.personal_data(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    assert [(s.kind, s.s, s.e) for s in row.base] == base(text)


def test_plan_is_native(spark, tmp_path):
    context_corpus(spark).write.parquet(str(tmp_path / "documents.parquet"))
    plan = pii.op5(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_empty(empty):
    assert pii.personal_data(empty).count() == 0

