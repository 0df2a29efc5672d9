"""Personal data by patterns of form, and by bootstrapped contexts; all in Spark's own functions.

Base spans match four forms (email, ip, card, phone). Slots are runs that may be identifiers: groups of
digits with their separators, and runs of other characters with a digit or ``@``. A slot whose value has a
base form, or is a quoted string of 32, 40 or 64 hexadecimal digits (a secret), is a seed; the others are
candidates. What stands around a slot gives its lexical patterns: one to three tokens before, one or two
after, tokens on both sides, and the same with words before the nearest mark replaced by their shape
(``<w> = "``). Patterns and instances are a graph. In each round a pattern's confidence for a kind is the
share of its distinct instances that are known to be of the kind, drawn towards 0 by ``SMOOTH`` instances
that are not; a candidate's score is the chance that one of its confident patterns is right; candidates
with a high score are known in the next round. In the end all occurrences of known candidates are spans,
too, and so are secrets that confident patterns lead to.

The regular expressions start only where a run starts (or where the last match ended, ``\\G``) and
don't backtrack, and places and contexts come from what lies between matches, so that the time is
nearly linear in the text and the number of matches. Nothing of a context or a slot is cut off.

Defined results: a null text counts as empty and has no span; base spans of one kind don't overlap; spans
of different kinds may, and an added span may hold a base one; ``^`` and ``$`` stand for a text's ends and
``&`` for a neighbouring slot in a context; rows with equal doc_id are rows of their own; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import place, text_or_empty, written

KINDS = ("email", "ip", "card", "phone")
SECRET = "secret"  # a kind of added spans only
ROUNDS = 3
LEAST_SUPPORT = 5  # distinct known instances of a pattern
SMOOTH = 1.0  # instances of another kind that every pattern is taken to have besides
LEAST_CONFIDENCE = 0.8  # of a pattern
LEAST_SCORE = 0.9  # of a candidate
SPAN = "struct<kind:string,s:int,e:int,value:string>"
BLOCK = 256  # matches that are folded at a time

_LOCAL = "[A-Za-z0-9._%+-]"
EMAIL = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
#: The whole run of digits and single separators, if it has 16 to 19 digits.
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_BYTE = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
IP_VALID = rf"^{_BYTE}\.{_BYTE}\.{_BYTE}\.{_BYTE}$".replace("*+", "*")
#: The same forms for whole values.
FORMS = {"email": rf"^{_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++$", "ip": IP_VALID, "card": r"^[0-9](?:[\x20-]?[0-9]){15,18}$", "phone": rf"^{PHONE}$"}
HEX = "^(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64})$"

_EDGE = r"\s\"'`,;=<>|(){}"  # characters that no run holds
_GROUPS = r"\(?\+?[0-9]++(?:[\x20().-]{1,3}+[0-9]++)++"
_RUN = rf"[^{_EDGE}0-9@]*+[0-9@](?:[^{_EDGE}\p{{L}}\p{{N}}_@]*+[\p{{L}}\p{{N}}_@])*+"
SLOT = rf"(?<![^{_EDGE}])(?:{_GROUPS}|{_RUN})"
_TOKEN = r"(\n|[\p{L}\p{N}_]++|[^\s\p{L}\p{N}_])"
_GAP = r"[^\S\n]*+"
BEFORE = rf"(?:(?:(?<![\p{{L}}\p{{N}}_]){_TOKEN}{_GAP})?(?<![\p{{L}}\p{{N}}_]){_TOKEN}{_GAP})?(?<![\p{{L}}\p{{N}}_]){_TOKEN}{_GAP}$"
AFTER = rf"^{_GAP}{_TOKEN}(?:{_GAP}{_TOKEN})?"


def _bind(value: Column, f) -> Column:
    """f of a value that is computed once."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _runs(text: Column, pattern: str, there: Column) -> Column:
    """array<struct<s, e, value, before, after>> of the leftmost non-overlapping matches, with the text between them.

    ``there``: a cheap test that some can exist. The texts between matches give their places, by a fold
    over blocks; ends are exclusive, in code points."""
    kind = "struct<s:int,e:int,value:string,before:string,after:string>"
    none = F.expr(f"cast(array() as array<{kind}>)")

    def step(acc: Column, x: Column) -> Column:
        s = acc["at"] + F.length(x["before"])
        e = s + F.length(x["value"])
        one = F.struct(s.alias("s"), e.alias("e"), x["value"].alias("value"), x["before"].alias("before"), x["after"].alias("after"))
        return F.struct(e.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    def block(acc: Column, part: Column) -> Column:
        done = F.aggregate(part, F.struct(acc["at"].alias("at"), none.alias("out")), step)
        return _bind(done, lambda d: F.struct(d["at"].alias("at"), F.concat(acc["out"], F.array(d["out"])).alias("out")))

    def placed(gaps: Column) -> Column:
        pairs = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda v, i: F.struct(v.alias("value"), F.get(gaps, i).alias("before"), F.get(gaps, i + 1).alias("after")))

        def fold(all_: Column) -> Column:
            parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / F.lit(BLOCK)).cast("int")), lambda k: F.slice(all_, k * BLOCK + 1, F.lit(BLOCK)))
            start = F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as array<array<{kind}>>)").alias("out"))
            return F.when(F.size(all_) == 0, none).otherwise(F.aggregate(parts, start, block, lambda acc: F.flatten(acc["out"])))

        return _bind(pairs, fold)

    return F.when(there, _bind(F.split(text, pattern, -1), placed)).otherwise(none)


def matches(text: Column, pattern: str, kind: str, there: Column) -> Column:
    """array<SPAN> of the leftmost non-overlapping matches; ``there``: a cheap test that some can exist."""
    return F.transform(_runs(text, pattern, there), lambda x: F.struct(F.lit(kind).alias("kind"), x["s"].alias("s"), x["e"].alias("e"), x["value"].alias("value")))


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, -i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def base_spans(text: Column) -> Column:
    """All base spans, by kind in their order, then by place."""
    email = matches(text, EMAIL, "email", F.contains(text, F.lit("@")))
    ip = F.filter(matches(text, IP, "ip", F.rlike(text, F.lit(r"[0-9]\.[0-9]"))), lambda x: F.rlike(x["value"], F.lit(IP_VALID)))
    card = F.filter(matches(text, CARD, "card", F.rlike(text, F.lit("[0-9][\\x20-]?[0-9]"))), lambda x: _luhn(_digits(x["value"])))
    phone = F.filter(matches(text, PHONE, "phone", F.contains(text, F.lit("+"))), lambda x: F.length(_digits(x["value"])).between(8, 15))
    return F.concat(email, ip, card, phone)


def slots(text: Column) -> Column:
    """array<struct<kind, s, e, value, left, right>>: the slots, their kinds if they are seeds, and the tokens
    around them, nearest first, in lower case."""

    def tokens(gap: Column, pattern: str, groups: list[int], end: Column) -> Column:
        named = lambda got: F.transform(got, lambda t, i: F.when(t != "", F.lower(t)).when((i == 0) | (F.get(got, i - 1) != ""), end).otherwise(F.lit("")))
        return _bind(F.array(*[F.regexp_extract(gap, pattern, g) for g in groups]), named)

    def kind(x: Column, left: Column, right: Column) -> Column:
        v = x["value"]
        form = lambda k: F.rlike(v, F.lit(FORMS[k]))
        quoted = F.get(left, F.lit(0)).isin('"', "'") & (F.get(right, F.lit(0)) == F.get(left, F.lit(0)))
        return (
            F.when(form("email"), "email").when(form("ip"), "ip").when(form("phone") & F.length(_digits(v)).between(8, 15), "phone")
            .when(form("card") & _luhn(_digits(v)), "card").when(F.rlike(v, F.lit(HEX)) & quoted, SECRET)
        )

    def one(x: Column, i: Column, n: Column) -> Column:
        left = tokens(x["before"], BEFORE, [3, 2, 1], F.when(i == 0, "^").otherwise("&"))
        right = tokens(x["after"], AFTER, [1, 2], F.when(i == n - 1, "$").otherwise("&"))
        skip = F.length(F.regexp_extract(x["value"], r"^[^\p{L}\p{N}_@+(]*+", 0))  # marks before the run itself
        bare = F.struct((x["s"] + skip).alias("s"), x["e"].alias("e"), F.substring(x["value"], skip + 1, F.length(x["value"])).alias("value"))
        return _bind(F.struct(bare.alias("x"), left.alias("left"), right.alias("right")), lambda y: F.struct(kind(y["x"], y["left"], y["right"]).alias("kind"), y["x"]["s"].alias("s"), y["x"]["e"].alias("e"), y["x"]["value"].alias("value"), y["left"].alias("left"), y["right"].alias("right")))

    def all_(found: Column) -> Column:
        return _bind(F.size(found), lambda n: F.transform(found, lambda x, i: one(x, i, n)))

    return _bind(_runs(text, SLOT, F.rlike(text, F.lit("[0-9@]"))), all_)


def scanned(docs: DataFrame) -> DataFrame:
    """(doc_id, base, slots) for each row, written."""
    df = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    df = df.select("doc_id", base_spans(F.col("text")).alias("base"), slots(F.col("text")).alias("slots"))
    return written(df, "pii-scan")


def _patterns(left: Column, right: Column) -> Column:
    """array<struct<side, words>>: the patterns of a slot."""
    at = lambda c, i: F.get(c, F.lit(i))
    shape = lambda t: F.when(F.rlike(t, F.lit(r"^[\p{L}_]")), "<w>").when(F.rlike(t, F.lit(r"^\p{N}")), "<n>").otherwise(t)
    one, two, three = at(left, 0), at(left, 1), at(left, 2)
    pair, triple = F.concat_ws(" ", two, one), F.concat_ws(" ", three, two, one)
    shaped = F.concat_ws(" ", shape(three), shape(two), one)
    r1, r2 = at(right, 0), F.concat_ws(" ", at(right, 0), at(right, 1))
    both = lambda a, b: F.concat(a, F.lit(" _ "), b)
    form = lambda side, words: F.struct(F.lit(side).alias("side"), words.alias("words"))
    sides = [("L", one), ("L", pair), ("L", triple), ("S", shaped), ("R", r1), ("R", r2), ("B", both(one, r1)), ("B", both(pair, r1)), ("B", both(triple, r1)), ("S", both(shaped, r1))]
    return F.array_distinct(F.array(*[form(a, b) for a, b in sides]))


def graph(scan: DataFrame) -> DataFrame:
    """(side, words, value, kind) of each pattern and instance that occur together; kind is null for candidates."""
    seen = scan.select(F.explode("slots").alias("x")).select(F.lower("x.value").alias("value"), "x.kind", F.explode(_patterns(F.col("x.left"), F.col("x.right"))).alias("p"))
    return seen.select("p.side", "p.words", "value", "kind").distinct()


def bootstrap(links: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame] | None:
    """Found values (value, kind, score), and the patterns (side, words, kind, confidence) that found them.

    None if no pattern of the seeds is confident."""
    links = written(links, "pii-links")
    size = written(links.groupBy("side", "words").agg(F.countDistinct("value").alias("n")).where(F.col("n") >= LEAST_SUPPORT), "pii-sizes")
    seeds = links.where("kind is not null").select("value", "kind", F.lit(1.0).alias("score")).distinct()
    known = seeds
    edges = links.select("side", "words", "value").distinct()
    wanted = links.where(F.col("kind").isNull() | (F.col("kind") == SECRET)).select("side", "words", "value").distinct()
    found = patterns = None
    for _ in range(rounds):
        by = edges.join(known, "value").groupBy("side", "words", "kind").agg(F.sum("score").alias("support"))
        confident = by.where(F.col("support") >= LEAST_SUPPORT).join(size, ["side", "words"])
        confident = confident.select("side", "words", "kind", (F.col("support") / (F.col("n") + SMOOTH)).alias("confidence")).where(F.col("confidence") >= LEAST_CONFIDENCE)
        patterns = written(confident, "pii-patterns")
        if patterns.isEmpty():
            break
        score = 1 - F.exp(F.sum(F.log(1 - F.least("confidence", F.lit(0.99)))))
        hits = wanted.join(patterns, ["side", "words"]).groupBy("value", "kind").agg(score.alias("score")).where(F.col("score") >= LEAST_SCORE)
        best = hits.groupBy("value").agg(F.max(F.struct("score", "kind")).alias("b")).select("value", "b.kind", "b.score")
        found = written(best, "pii-found")
        known = seeds.union(found.join(seeds, "value", "left_anti"))
    return None if found is None else (found, patterns)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")


def personal_data(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """A row for each row of docs: doc_id, base and all spans (array<SPAN>); spans by kind (``secret`` last), then place."""
    scan = scanned(docs)
    known = bootstrap(graph(scan), rounds)
    if known is None or known[0].isEmpty():
        return scan.select("doc_id", "base", F.col("base").alias("spans"))
    file, row = place(scan)
    rows = scan.select("doc_id", "base", "slots", file.alias("file"), row.alias("row"))
    free = F.filter("slots", lambda x: x["kind"].isNull() | (x["kind"] == SECRET))
    seen = rows.select("file", "row", F.explode(free).alias("x")).withColumn("value", F.lower("x.value")).join(known[0], "value")
    added = seen.groupBy("file", "row").agg(F.collect_list(F.struct("kind", F.col("x.s").alias("s"), F.col("x.e").alias("e"), F.col("x.value").alias("value"))).alias("added"))  # of one document
    rows = rows.select("doc_id", "base", "file", "row").join(added, ["file", "row"], "left").withColumn("all", F.concat("base", F.coalesce("added", F.expr(f"cast(array() as array<{SPAN}>)"))))
    order = F.array(*[F.lit(k) for k in (*KINDS, SECRET)])
    keyed = F.transform("all", lambda x: F.struct(F.array_position(order, x["kind"]).alias("k"), x["s"].alias("s"), x["e"].alias("e"), x["value"].alias("value"), x["kind"].alias("kind")))
    spans = F.transform(F.array_sort(keyed), lambda x: F.struct(x["kind"].alias("kind"), x["s"].alias("s"), x["e"].alias("e"), x["value"].alias("value")))
    return rows.select("doc_id", "base", spans.alias("spans"))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents``."""
    rows = personal_data(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("bigint").alias(f"n_{k}")
    return rows.select("doc_id", *[count(k) for k in KINDS], F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))
