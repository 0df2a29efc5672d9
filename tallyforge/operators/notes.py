"""Notes that were read badly: rows over several lines, split decimals, columns known only by their place.

Everything here works on arrays within a page's row: lines are typed once, a table of transitions says what
follows from their order, and only the rows found leave the page. Nothing is dealt out, and a page costs
what its lines cost."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import numbers
from ..functions import text as T
from ..functions.numbers import let
from .schedules import NOTE_LABELS

L = numbers.LAKH
EMITTED = "array<struct<action:string,held:int,at:int>>"


def transduce(events: Column, table: Sequence[tuple[str, str, str, str]], start: str = "open") -> Column:
    """What a table of transitions emits over an array of events, as (action, held, at) in order.

    A transition is (state, event, next state, actions); an event without one leads back to ``start``. The
    actions are names apart by spaces: ``hold`` keeps the event's place, any other is emitted with the
    place that is held (or -1) and its own."""
    moves = F.create_map(*[x for s, e, to, do in table for x in (F.lit(f"{s}|{e}"), F.struct(F.lit(to).alias("to"), F.array(*[F.lit(a) for a in do.split() if a != "hold"]).cast("array<string>").alias("do"), F.lit("hold" in do.split()).alias("hold")))])
    none = F.struct(F.lit(start).alias("to"), F.array().cast("array<string>").alias("do"), F.lit(False).alias("hold"))

    def step(acc: Column, e: Column) -> Column:
        def moved(m: Column) -> Column:
            emitted = F.transform(m["do"], lambda a: F.struct(a.alias("action"), acc["held"].alias("held"), acc["at"].alias("at")))
            out = F.when(F.size(m["do"]) > 0, F.concat(acc["out"], emitted)).otherwise(acc["out"])
            return F.struct(m["to"].alias("state"), F.when(m["hold"], acc["at"]).otherwise(F.lit(-1)).alias("held"), (acc["at"] + 1).alias("at"), out.alias("out"))

        return let(F.coalesce(F.try_element_at(moves, F.concat(acc["state"], F.lit("|"), e)), none), moved)

    zero = F.struct(F.lit(start).alias("state"), F.lit(-1).alias("held"), F.lit(0).alias("at"), F.array().cast(EMITTED).alias("out"))
    return F.aggregate(events, zero, step, lambda acc: acc["out"])


#: What a line of the asset note means after the one before it: a label without figures takes the next line's, whatever
#: else that line is; so does a bare total.
NOTE_MOVES = (
    ("open", "both", "open", "own"),
    ("open", "label", "label", "hold"),
    ("open", "total_row", "open", "total"),
    ("open", "total", "total", "hold"),
    ("label", "both", "open", "held own"),
    ("label", "label", "label", "hold"),
    ("label", "total_row", "open", "held total"),
    ("label", "total", "total", "hold"),
    ("label", "figures", "open", "held"),
    ("total", "both", "open", "total_held own"),
    ("total", "label", "label", "hold"),
    ("total", "total_row", "open", "total"),
    ("total", "total", "total", "hold"),
    ("total", "figures", "open", "total_held"),
)
#: Capital work in progress: the first total of its note that has two different figures.
WORK_MOVES = (
    ("open", "header", "in", ""),
    ("in", "header", "in", ""),
    ("in", "other", "in", ""),
    ("in", "total", "done", "work"),
    ("done", "header", "done", ""),
    ("done", "other", "done", ""),
    ("done", "total", "done", ""),
)
#: Rows that a sub-total of gross values covers. Fixed values.
SUMMED_ROWS = (2, 3, 4, 5, 7)
FIELDS = ("gross_opening", "gross_addition_reval", "gross_addition_actual", "gross_deduction", "gross_closing", "dep_up_to_beginning", "dep_provided_during_year", "dep_adjustment", "dep_up_to_end", "net_opening", "net_closing")
ROW = "struct<sl_no:int," + ",".join(f"{f}:double" for f in FIELDS) + ">"


def rupees(x: Column) -> Column:
    """Lakhs as rupees, to the paisa: 633.84 lakhs are 63,384,000 and no part of a paisa more, so that what amounts are compared with is met exactly."""
    return F.round(x * L, 2)


def lakh_figures(line: Column) -> Column:
    """The positive lakh figures of a line, misread separators repaired."""
    tokens = F.filter(F.regexp_extract_all(line, F.lit(r"[\d,.\-]+"), F.lit(0)), lambda t: F.rlike(t, F.lit(r"\d")))
    return F.filter(F.transform(tokens, lambda t: figure(t, numbers.normalize_lakhs_token)), lambda v: v > 0)


def figure(t: Column, repair: Callable[[Column], Column] = lambda t: t) -> Column:
    """A token in lakhs; most are written well and need no repair."""
    plain = F.rlike(t, F.lit(r"^(\d{1,3}(,\d{2,3})*\.\d\d|\d+\.\d{1,2})$"))
    return F.when(plain, F.replace(t, F.lit(","), F.lit("")).try_cast("double")).otherwise(let(repair(t), lambda x: numbers.lakhs_decimal(x)))


def plausible_figures(v: Column) -> Column:
    """An array of more than four figures without those far above its upper median."""

    def kept(m: Column) -> Column:
        cap = F.when(m >= 100, F.greatest(m * 4, F.lit(8_000.0))).otherwise(F.greatest(m * 8, F.lit(3_000.0)))
        odd = lambda x: (x > cap) | ((x >= 5_000) & (m < 800)) | ((m > 50) & (x > m * 6)) | ((x >= 20_000) & (m < 5_000))
        return F.filter(v, lambda x: ~odd(x))

    return F.when(F.size(v) <= 4, v).otherwise(let(F.get(F.array_sort(v), F.floor(F.size(v) / 2).cast("int")), kept))


def neighbours(v: Column, first: int, last: int) -> Column:
    """Neighbouring figures at places first to last - 1, as (o, c, ratio)."""
    part = F.slice(v, F.lit(first + 1), F.lit(last - first + 1))
    n = F.greatest(F.size(part) - 1, F.lit(0))
    return F.zip_with(F.slice(part, F.lit(1), n), F.slice(part, F.lit(2), n), lambda a, b: F.struct(a.alias("o"), b.alias("c"), (F.least(a, b) / F.greatest(a, b)).alias("ratio")))


def picked_net_pair(v: Column) -> Column:
    """struct(opening, closing) of the net block among a row's figures, in lakhs.

    In this order: a first figure that comes again at the third place; the first neighbours of like size within a
    middle band; of the figures of a size that the largest allows, neighbours of nearly one size: large ones that rise at
    the start, the first that fall, those of the largest smaller figure; else the first two."""
    some = F.element_at
    pair = lambda p: F.struct(p["o"].alias("opening"), p["c"].alias("closing"))
    first = lambda ps, good: F.get(F.filter(ps, good), F.lit(0))

    def of(hi: Column) -> Column:
        cap = F.when(hi >= 200, F.least(F.lit(500.0), hi * 0.35)).otherwise(500.0)
        middle = first(neighbours(v, 1, 5), lambda p: p["o"].between(1, cap) & p["c"].between(1, cap) & (p["ratio"] >= 0.25))
        least = F.when(hi >= 5_000, 500.0).when(hi >= 500, 50.0).otherwise(5.0)

        def among(c: Column) -> Column:
            near = lambda p: p["ratio"] >= 0.75
            rise = first(neighbours(c, 0, 1), lambda p: near(p) & (p["c"] > p["o"]) & (p["o"] >= 10_000))
            fall = first(neighbours(c, 1, 5), lambda p: near(p) & (p["c"] < p["o"]))
            ranked = F.transform(neighbours(c, 0, 4), lambda p, i: F.struct(F.when(near(p), F.least(p["o"], p["c"])).alias("key"), (-i).alias("i"), p.alias("p")))
            like = F.array_max(F.filter(ranked, lambda r: r["key"].isNotNull()))["p"]
            head = F.struct(some(c, 1).alias("o"), some(c, 2).alias("c"), F.lit(0.0).alias("ratio"))
            return F.when(F.size(c) >= 2, pair(F.coalesce(rise, fall, like, head)))

        return F.coalesce(F.when(middle.isNotNull(), pair(middle)), let(F.filter(v, lambda x: x.between(least, 50_000)), among))

    again = (F.size(v) >= 3) & (F.abs(F.get(v, F.lit(0)) - F.get(v, F.lit(2))) < F.greatest(F.get(v, F.lit(0)), F.lit(1.0)) * 0.005)
    return F.when(again, F.struct(F.get(v, F.lit(1)).alias("opening"), F.get(v, F.lit(0)).alias("closing"))).when(F.size(v) >= 2, let(F.array_max(v), of))


def _row(sl: Column, **fields: Column) -> Column:
    return F.struct(sl.cast("int").alias("sl_no"), *[F.coalesce(fields.get(f, F.lit(0.0)), F.lit(0.0)).cast("double").alias(f) for f in FIELDS])


def asset_fields(sl: Column, raw: Column, v: Column) -> Column:
    """A block C row in rupees from a note row's plausible figures ``v``: net closing and opening, then the charge, gross
    values, movements; null if there is none.

    The charge is the fourth figure where that explains the fall of the net block, else the least small one of the
    fourth to seventh. Of the figures after the eighth (of a short row, the sixth) the largest two from 50 on are gross
    closing and opening, small ones an addition and a deduction. Where fewer than two figures are plausible, the net
    block is picked from all."""
    at = lambda k: F.get(v, F.lit(k))
    small = F.filter(F.slice(v, F.lit(4), F.lit(4)), lambda x: x < 500)
    charge = F.when(F.size(v) >= 4, F.when(F.abs(at(0) - at(1) - at(3)) <= F.greatest(F.lit(2.0), at(0) * 0.02), at(3)).otherwise(F.array_min(small)))
    tail = F.when(F.size(v) > 8, F.slice(v, F.lit(9), F.size(v))).otherwise(F.slice(v, F.lit(7), F.size(v)))

    def row(t: Column) -> Column:
        big = F.reverse(F.array_sort(F.filter(t, lambda x: x >= 50)))
        moves = F.filter(t, lambda x: x < 200)
        return _row(
            sl, net_closing=rupees(at(0)), net_opening=rupees(at(1)), dep_provided_during_year=rupees(charge), gross_closing=rupees(F.get(big, F.lit(0))), gross_opening=rupees(F.get(big, F.lit(1))),
            gross_addition_actual=rupees(F.array_max(moves)), gross_deduction=F.when(F.size(moves) >= 2, rupees(F.array_min(moves))),
        )

    def net_only(p: Column) -> Column:
        return F.when((p["opening"] > 0) | (p["closing"] > 0), _row(sl, net_opening=rupees(p["opening"]), net_closing=rupees(p["closing"])))

    return F.when(F.size(v) >= 2, let(tail, row)).otherwise(let(picked_net_pair(raw), net_only))


def _depreciated(r: Column) -> Column:
    """Depreciation at both ends as gross less net, else carried on by the charge."""
    left = lambda g, n: F.when((r[g] > 0) & (r[n] > 0), F.greatest(F.lit(0.0), r[g] - r[n])).otherwise(r[f"dep_up_to_{'end' if 'closing' in g else 'beginning'}"])
    end, begin = left("gross_closing", "net_closing"), left("gross_opening", "net_opening")
    return r.withField("dep_up_to_beginning", begin).withField("dep_up_to_end", F.when((end <= 0) & (begin > 0), begin + r["dep_provided_during_year"]).otherwise(end))


def _less(r: Column) -> Column:
    """A gross value that falls without deduction fell by one."""
    fell = (r["gross_closing"] > 0) & (r["gross_opening"] > 0) & (r["gross_closing"] < r["gross_opening"]) & (r["gross_deduction"] == 0)
    return r.withField("gross_deduction", F.when(fell, r["gross_opening"] - r["gross_closing"]).otherwise(r["gross_deduction"])).withField("gross_addition_actual", F.when(fell, 0.0).otherwise(r["gross_addition_actual"]))


def _more(r: Column) -> Column:
    """The addition is what gross values imply where it is missing or far off."""
    implied = F.greatest(F.lit(0.0), r["gross_closing"] - r["gross_opening"] - r["gross_deduction"])
    off = (r["gross_addition_actual"] == 0) | (F.abs(r["gross_addition_actual"] - implied) > F.greatest(implied * 0.5, F.lit(50_000.0)))
    return r.withField("gross_addition_actual", F.when((r["gross_closing"] > 0) & (r["gross_opening"] > 0) & off, implied).otherwise(r["gross_addition_actual"]))


def _charged(r: Column) -> Column:
    """Depreciation at the end follows from the beginning and the charge, or the charge from both."""
    begin, end, adjust, charge = (r[f] for f in ("dep_up_to_beginning", "dep_up_to_end", "dep_adjustment", "dep_provided_during_year"))
    known = (begin > 0) | (charge > 0)
    implied = F.greatest(F.lit(0.0), end - begin + adjust)
    fix = ~known & (end > 0) & ((charge == 0) | (F.abs(charge - implied) > implied * 0.5))
    return r.withField("dep_up_to_end", F.when(known, F.greatest(F.lit(0.0), begin + charge - adjust)).when(fix, F.greatest(F.lit(0.0), begin + implied - adjust)).otherwise(end)).withField("dep_provided_during_year", F.when(fix, implied).otherwise(charge))


def aligned(rows: Column) -> Column:
    """Block C rows whose additions, deductions and depreciation agree with their closing values."""
    for step in (_less, _more, _charged):
        rows = F.transform(rows, step)
    return rows


def _once(rows: Column) -> Column:
    """The first row of each number; rows of number 5, which holds several assets, are summed."""

    def put(acc: Column, r: Column) -> Column:
        added = F.transform(acc, lambda a: F.when(a["sl_no"] == 5, F.struct(a["sl_no"].alias("sl_no"), *[(a[f] + r[f]).alias(f) for f in FIELDS])).otherwise(a))
        return F.when(~F.exists(acc, lambda a: a["sl_no"] == r["sl_no"]), F.concat(acc, F.array(r))).when(r["sl_no"] == 5, added).otherwise(acc)

    return F.aggregate(rows, F.array().cast(f"array<{ROW}>"), put)


def _imputed(rows: Column, field: str, subtotal: Column) -> Column:
    """Rows of which the one that a sub-total contradicts most plainly (the largest that is off, the later on ties) takes
    what the others leave of it."""
    other = "gross_closing" if field == "gross_opening" else "gross_opening"
    summed = F.aggregate(F.filter(rows, lambda r: r["sl_no"].isin(*SUMMED_ROWS)), F.lit(0.0), lambda a, r: a + r[field])

    def done(total: Column) -> Column:
        implied = lambda r: subtotal - (total - r[field])
        off = lambda r: r["sl_no"].isin(*SUMMED_ROWS) & (implied(r) > 0) & (F.abs(r[field] - implied(r)) / implied(r) > 0.02)
        pick = F.array_max(F.transform(F.filter(rows, off), lambda r: F.struct(r[field].alias("v"), r["sl_no"].alias("sl_no"))))["sl_no"]

        def taken(r: Column) -> Column:
            move = (r["gross_closing"] - implied(r)) if field == "gross_opening" else (implied(r) - r["gross_opening"])
            grown = (r["gross_addition_actual"] == 0) & (move > 0) & ((r[other] > 0) if field == "gross_closing" else F.lit(True))
            return r.withField(field, implied(r)).withField("gross_addition_actual", F.when(grown, move - r["gross_deduction"]).otherwise(r["gross_addition_actual"]))

        def one(sl: Column) -> Column:
            return F.transform(rows, lambda r: F.when(r["sl_no"] == sl, F.get(aligned(F.array(taken(r))), F.lit(0))).otherwise(r))

        return F.when(pick.isNotNull(), let(pick, one)).otherwise(rows)

    return F.when(subtotal >= 1e8, let(summed, done)).otherwise(rows)


def asset_note(page_text: DataFrame) -> DataFrame:
    """(doc_id, page_no, sl_no and the eleven fields of block C) of lakh notes on property, read line by line.

    Lines are typed as label, figures, both, total or neither, and a table of transitions pairs labels with figures on
    their own or the next line; lines with tabs have their label in the first cell. The first row of a number counts;
    computers and office equipment add up to row 5. Row 9 is capital work in progress, row 10 the total; a gross
    sub-total corrects the row that contradicts it. Lines of more than 200 characters have no label. Null and empty
    texts have no rows."""
    low = F.lower("text")
    notes = page_text.where(F.rlike(low, F.lit(r"amounts?\s+.{0,6}lacs?|in\s+lacs?")) & F.rlike(low, F.lit(r"property[.,]?\s*plant")))
    body = F.element_at(F.split("text", "=== PADDLEOCR ==="), -1)

    def typed(line: Column) -> Column:
        return let(F.struct(line.alias("line"), F.lower(F.trim(line)).alias("low"), F.contains(line, F.lit("\t")).alias("tab")), labelled)

    def labelled(x: Column) -> Column:
        name = F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.when(x["tab"], F.substring_index(x["line"], "\t", 1)).otherwise(x["line"])), r"[^a-z0-9\s]", " "), r"\s+", " "))
        own = F.when(x["tab"], F.regexp_replace(x["line"], r"^[^\t]*\t", "")).otherwise(x["line"])

        def numbered(name: Column) -> Column:
            sl = F.lit(None).cast("int")
            for n, pattern in reversed(NOTE_LABELS):
                sl = F.when(F.rlike(name, F.lit(pattern)), n).otherwise(sl)
            return sl

        some = F.rlike(x["low"], F.lit(r"land|building|plant|vehicle|computer|office|lab|furniture"))
        sl = F.when((F.length(x["line"]) <= 200) & some, F.when(~(x["tab"] & ~F.rlike(own, F.lit(r"\d"))), let(name, numbered)))
        found = F.struct(x["low"].alias("low"), x["tab"].alias("tab"), own.alias("own"), F.rlike(x["low"], F.lit(r"^total\b")).alias("total"), sl.alias("sl_no"), lakh_figures(x["line"]).alias("figures"))
        return let(found, told)

    def told(x: Column) -> Column:
        v, low = x["figures"], x["low"]
        kind = (
            F.when(x["sl_no"].isNotNull(), F.when(F.rlike(x["own"], F.lit(r"\d")), "both").otherwise("label"))
            .when(x["total"] & (F.size(v) >= 2) & (F.get(v, F.lit(0)) >= 1_000), "total_row")
            .when(low == "total", "total")
            .when(F.size(v) >= 2, "figures")
            .otherwise("other")
        )
        apart = F.aggregate(F.filter(v, lambda y: y.between(500, 20_000)), F.array().cast("array<double>"), lambda kept, y: F.when((F.size(kept) > 0) & (F.abs(y - F.element_at(kept, -1)) <= 0.05), kept).otherwise(F.concat(kept, F.array(y))))
        header = F.contains(low, F.lit("capital")) & F.rlike(low, F.lit(r"(^\d{1,2}\s*:|note\s*5\b).*capital\s+work|capital\s+work-in-progress\s+ageing"))
        total = (F.size(v) >= 2) & F.rlike(low, F.lit(r"\btotal\b")) & ~F.rlike(low, F.lit(r"ageing|period\s+of|amount\s+in\s+cwip"))
        made = F.struct(kind.alias("kind"), x["sl_no"].alias("sl_no"), v.alias("figures"), F.when(x["sl_no"].isNotNull() & x["tab"], lakh_figures(x["own"])).otherwise(v).alias("own"), F.when(total, apart).alias("pair"), x["total"].alias("total"), header.alias("header"))
        return let(made, lambda m: F.struct(*[m[f].alias(f) for f in ("kind", "sl_no", "figures", "own", "pair", "total")], F.when(m["header"], "header").when(F.size(m["pair"]) >= 2, "total").otherwise("other").alias("step")))

    rows = notes.select("doc_id", "page_no", body.alias("body"), F.transform(F.split(body, "\n"), typed).alias("lines"))
    rows = rows.withColumn("emitted", transduce(F.transform("lines", lambda x: x["kind"]), NOTE_MOVES)).withColumn("worked", transduce(F.transform("lines", lambda x: x["step"]), WORK_MOVES))
    line = lambda at: F.get("lines", at)
    found = F.transform(
        F.filter("emitted", lambda e: e["action"].isin("own", "held")),
        lambda e: F.when(e["action"] == "own", F.struct(line(e["at"])["sl_no"].alias("sl_no"), line(e["at"])["own"].alias("v"))).otherwise(F.struct(line(e["held"])["sl_no"].alias("sl_no"), line(e["at"])["figures"].alias("v"))),
    )
    found = F.transform(F.filter(found, lambda f: F.size(f["v"]) >= 2), lambda f: F.struct(f["sl_no"], f["v"].alias("raw"), plausible_figures(f["v"]).alias("v")))
    rows = rows.withColumn("rows", F.array_compact(F.transform(found, lambda f: asset_fields(f["sl_no"], f["raw"], f["v"]))))
    rows = rows.withColumn("rows", aligned(F.transform("rows", _depreciated))).withColumn("rows", _once(F.col("rows")))
    figures_of = lambda action: F.get(F.filter(F.transform(F.filter("emitted", lambda e: e["action"] == action), lambda e: line(e["at"])["figures"]), lambda v: (F.size(v) >= 2) & (F.get(v, F.lit(0)) >= 1_000)), F.lit(0))
    flat = F.regexp_replace("body", "\n", " ")
    property_at = lambda k: numbers.lakhs_decimal(numbers.normalize_lakhs_token(F.regexp_extract(flat, r"(?i)property[^\d]{0,40}plant[^\d]{0,40}equipment[^\d]*([\d,.\-]+)\s+([\d,.\-]+)", k)))
    rows = rows.withColumn("total", F.coalesce(figures_of("total"), figures_of("total_held")))
    rows = rows.withColumn("total", F.when(F.col("total").isNotNull(), F.slice("total", 1, 2)).otherwise(F.filter(F.array(property_at(1), property_at(2)), lambda v: v > 0)))
    first_total = F.filter(F.get(F.filter("lines", lambda x: x["total"]), F.lit(0))["figures"], lambda v: v >= 500)
    rows = rows.withColumn("gross", F.when(F.size(first_total) >= 2, F.struct(rupees(F.get(first_total, F.lit(0))).alias("opening"), rupees(F.element_at(first_total, -1)).alias("closing"))))
    for field, side in (("gross_opening", "opening"), ("gross_closing", "closing")):
        rows = rows.withColumn("rows", _imputed(F.col("rows"), field, F.col(f"gross.{side}")))
    work = line(F.get("worked", F.lit(0))["at"])["pair"]
    extra = F.array_compact(
        F.array(
            F.when(F.size(work) >= 2, _row(F.lit(9), net_opening=rupees(F.element_at(work, -2)), net_closing=rupees(F.element_at(work, -1)))),
            F.when(F.size("total") == 2, _row(F.lit(10), net_opening=rupees(F.get("total", F.lit(1))), net_closing=rupees(F.get("total", F.lit(0))))),
        )
    )
    return rows.select("doc_id", "page_no", F.inline(F.concat("rows", extra)))


# --- split decimals


def segmented(tokens: Column, count: int, low: float, high: float) -> Column:
    """The ``count`` amounts that a row's tokens most likely are, in lakhs; null if they can't be so many.

    A dynamic program over the tokens: each is an amount, the last two digits of the one before it (two bare digits
    after a token without point), or neither. Amounts within the band score 2 if they have decimals, joined ones
    included, else 1; outside it -3; a token left out -0.5. Of equal scores the segmentation that joins earliest counts."""
    way = "struct<less:double,path:string,v:array<double>>"

    def scored(x: Column, decimals: Column) -> Column:
        return F.when(~x.between(low, high), -3.0).otherwise(F.when(decimals, 2.0).otherwise(1.0))

    def typed(t: Column, i: Column) -> Column:
        """A token as an amount, and joined to the one before it."""
        before = F.when(i > 0, F.get(tokens, i - 1))
        fits = F.rlike(t, F.lit(r"^\d\d$")) & ~F.contains(before, F.lit("."))
        alone, joined = figure(t, numbers.repair_fragment), F.when(fits, figure(F.concat(before, F.lit("."), t)))
        return let(F.struct(alone.alias("alone"), joined.alias("joined")), lambda x: F.struct(x["alone"], scored(x["alone"], F.rlike(t, F.lit(r"[.:]\d{1,2}$|^\d,\d{5}$"))).alias("score"), x["joined"], F.when(x["joined"].isNotNull(), scored(x["joined"], F.lit(True))).alias("joined_score")))

    def added(w: Column, score: Column, mark: str, x: Column | None = None) -> Column:
        return F.when(w.isNotNull() & score.isNotNull(), F.struct((w["less"] - score).alias("less"), F.concat(w["path"], F.lit(mark)).alias("path"), (w["v"] if x is None else F.concat(w["v"], F.array(x))).alias("v")))

    def step(acc: Column, t: Column) -> Column:
        def at(skipped: Column, k: Column) -> Column:
            one = lambda ways: F.when(k > 0, F.get(acc[ways], k - 1))
            return F.array_min(F.array_compact(F.array(added(one("last"), t["score"], "k", t["alone"]), added(one("before"), t["joined_score"], "j", t["joined"]), added(skipped, F.lit(-0.5), "s"))))

        return F.struct(acc["last"].alias("before"), F.transform(acc["last"], at).alias("last"))

    begin = F.transform(F.sequence(F.lit(0), F.lit(count)), lambda k: F.when(k == 0, F.struct(F.lit(0.0).alias("less"), F.lit("").alias("path"), F.array().cast("array<double>").alias("v"))).cast(way))
    none = F.transform(F.sequence(F.lit(0), F.lit(count)), lambda k: F.lit(None).cast(way))
    zero = F.struct(none.alias("before"), begin.alias("last"))
    return F.aggregate(F.transform(tokens, typed), zero, step, lambda acc: F.get(acc["last"], F.lit(count))["v"])


#: Places of a wide inventory row: total, stores, finished goods, raw material, in progress; and their block D rows. Fixed values.
INVENTORY = ((1, 3), (3, 1), (5, 4), (6, 2))


def wide_inventory(page_text: DataFrame, low: float = 1.0, high: float = 100_000.0) -> DataFrame:
    """(doc_id, page_no, sl_no, opening_rs, closing_rs) of the inventory note's wide row: five amounts of each side.

    The first line that names inventories, has eight figures above one lakh and can be read as ten amounts counts.
    ``balanced`` says whether each side's parts are its total. Row 2 is 0, as the note doesn't have it."""
    rows = page_text.where(F.rlike(F.lower("text"), F.lit(r"inventor|note\s*8")))
    token = r"[\d,.:!?]+"

    def read(line: Column) -> Column:
        tokens = F.filter(F.regexp_extract_all(line, F.lit(token), F.lit(0)), lambda t: F.rlike(t, F.lit(r"\d")))
        large = F.filter(F.transform(tokens, lambda t: figure(t)), lambda v: v > 1)
        return F.when(F.size(large) >= 8, segmented(F.transform(tokens, lambda t: F.regexp_replace(t, r"^\?|[.,:]+$", "")), 10, low, high))

    def parts(v: Column) -> Column:
        at = lambda k: F.get(v, F.lit(k))
        side = lambda k: F.abs(at(k) - at(k + 1) - at(k + 2) - at(k + 3) - at(k + 4)) <= at(k) * 0.001
        one = lambda sl, o, c: F.struct(F.lit(sl).alias("sl_no"), (side(0) & side(5)).alias("balanced"), (o * L).alias("opening_rs"), (c * L).alias("closing_rs"))
        return F.array(*[one(sl, at(5 + k), at(k)) for sl, k in INVENTORY], one(2, F.lit(0.0), F.lit(0.0)))

    named = F.filter(F.split("text", "\n"), lambda x: F.rlike(F.lower(x), F.lit("inventor")))
    found = F.filter(F.transform(named, read), lambda v: v.isNotNull())
    return rows.select("doc_id", "page_no", F.inline(F.flatten(F.transform(F.slice(found, F.lit(1), F.lit(1)), parts))))


def opening_sum(parts: Column) -> Column:
    """The sum of an opening side: a first figure above 40 is its anchor and doesn't count, nor does what repeats it
    (43 to 47); a figure below 10 and a next one below 100 right after the anchor are parts of one amount; a figure below 1 goes with the
    one from 50 on before it; after 120 a figure below 3 ends the sum."""
    begin = F.when(F.get(parts, F.lit(0)) > 40, 1).otherwise(0)

    def of(v: Column) -> Column:
        a, b = F.get(v, F.lit(0)), F.get(v, F.lit(1))
        split = (F.size(v) >= 2) & (a < 10) & (b < 100)
        start = F.when(split, F.when(b >= 10, a + b / 100).otherwise(a + b)).otherwise(0.0)
        rest = F.when(split, F.slice(v, F.lit(3), F.size(v))).otherwise(v)

        def step(acc: Column, x: Column) -> Column:
            decimal = acc["large"] & (x < 1)  # belongs to the figure before it, whatever the sum is
            stop = acc["over"] | (~decimal & ~x.between(43, 47) & (acc["sum"] > 120) & (x < 3))
            counts = ~stop & (decimal | ~x.between(43, 47))
            return F.struct((acc["sum"] + F.when(counts, x).otherwise(0.0)).alias("sum"), (counts & ~decimal & (x >= 50)).alias("large"), stop.alias("over"))

        return F.aggregate(rest, F.struct(start.alias("sum"), F.lit(False).alias("large"), F.lit(False).alias("over")), step, lambda acc: acc["sum"])

    return F.when(F.size(parts) == 0, 0.0).otherwise(let(F.slice(parts, begin + 1, F.size(parts)), of))


def cash_note(page_text: DataFrame) -> DataFrame:
    """(doc_id, page_no, opening, closing) in rupees of the note on cash: one wide row split at its pivot, a figure from 43 to 47.

    Before the pivot stands the closing side, of which a figure from 20 to 40 is cash, else the largest from above 5 to
    100; after it the opening side, which is summed. The last line on deposits gives the bank balance: the largest
    figure from 3 to 5, else the first from 2 to 15. Of several rows the last counts."""
    rows = page_text.where(F.rlike(F.lower("text"), F.lit(r"cash\s+on\s+hand|cash\s+and\s+cash")))
    body = F.element_at(F.split("text", "=== PADDLEOCR ==="), -1)
    has = lambda x, *words: F.contains(x, F.lit(words[0])) & (F.contains(x, F.lit(words[1])) if len(words) > 1 else F.lit(True))
    deposits = r"reman\w*.*(month|monti)|matur.*(month|monti)"

    def figures(line: Column) -> Column:
        tokens = F.filter(F.regexp_extract_all(line, F.lit(r"[\d,.]+"), F.lit(0)), lambda t: ~t.isin(".", "10", "104"))
        return F.filter(F.transform(tokens, lambda t: figure(t)), lambda v: (v > 0) & ~((v > 9.5) & (v < 10.5)))

    def cash(line: Column) -> Column:
        def split(v: Column) -> Column:
            pivot = F.array_position(F.transform(v, lambda x: x.between(43, 47)), True).cast("int")
            closing = F.slice(v, F.lit(1), F.greatest(pivot - 1, F.lit(0)))
            inner = F.coalesce(F.get(F.filter(closing, lambda x: x.between(20, 40)), F.lit(0)), F.array_max(F.filter(closing, lambda x: (x > 5) & (x <= 100))), F.lit(0.0))
            return F.when((F.size(v) >= 6) & (pivot > 0), F.struct(inner.alias("closing"), opening_sum(F.slice(v, pivot + 1, F.size(v))).alias("opening")))

        return F.when(has(F.lower(line), "cash on hand", "bank balances other"), let(F.filter(figures(line), lambda x: x < 50_000), split))

    def bank(line: Column) -> Column:
        def of(v: Column) -> Column:
            return F.coalesce(F.array_max(F.filter(v, lambda x: x.between(3, 5))), F.get(F.filter(v, lambda x: x.between(2, 15)), F.lit(0)), F.lit(0.0))

        low = F.lower(line)
        return F.when(has(low, "fixed", "deposit") | F.rlike(low, F.lit(deposits)), let(F.filter(figures(line), lambda x: x < 200), of))

    last = lambda read: F.try_element_at(F.filter(F.transform("lines", read), lambda x: x.isNotNull()), F.lit(-1))
    rows = rows.select("doc_id", "page_no", F.split(body, "\n").alias("lines")).select("doc_id", "page_no", last(cash).alias("cash"), F.coalesce(last(bank), F.lit(0.0)).alias("bank"))
    nil = F.lit(0.0)
    out = rows.select("doc_id", "page_no", (F.coalesce("cash.opening", nil) * L).alias("opening"), F.coalesce("cash.closing", nil).alias("c"), "bank")
    return out.where("c != 0 or bank != 0").select("doc_id", "page_no", "opening", ((F.col("c") + F.col("bank")) * L).alias("closing"))


# --- columns known by their place


def offset_pairs(values: Column, offset: int) -> Column:
    """(closing, opening): each of the first ``offset`` values with the one so many places on."""
    part = lambda k: F.slice(values, F.lit(k), F.lit(offset))
    return F.zip_with(part(1), part(1 + offset), lambda c, o: F.struct(c.alias("closing"), o.alias("opening")))


#: Note columns of the tabular face; places of its components and the limits of their closing values; lines of the
#: summary with note number and most closing value. Fixed values.
FACE_NOTES = ("6", "7", "8", "9")
FACE_PLACES = ((2, "face.trade_receivables", 0.0, 5e7), (3, "face.loans_and_advances", 5e7, 1e18))
FACE_LINES = (
    (r"unsecured\s+loan", 4, "face.unsecured_loan", 1e8),
    (r"trade\s+receiv\w*", 7, "face.trade_receivables", 5e7),
    (r"loans?\s*[.&\s]*advan\w*", 9, "face.loans_and_advances", 1e18),
)
FOUND = "array<struct<key:string,opening:double,closing:double>>"


def face_row(line: Column) -> Column:
    """Components of a tabular face row, by place: after the last note column ten amounts above 100,000, five closing
    and five opening ones. Lines with fewer notes or amounts have none."""
    cells = F.transform(F.split(line, "\t"), lambda x: F.trim(x))

    def of(c: Column) -> Column:
        notes = F.filter(F.transform(c, lambda x, i: F.when(x.isin(*FACE_NOTES), i)), lambda i: i.isNotNull())

        def after(start: Column) -> Column:
            amounts = F.filter(F.transform(F.slice(c, start + 2, F.size(c)), numbers.clean_number), lambda v: v > 100_000)

            def read(v: Column) -> Column:
                pairs = offset_pairs(v, 5)
                found = [_within(F.get(pairs, F.lit(k)), key, low, high) for k, key, low, high in FACE_PLACES]
                return F.when(F.size(v) >= 10, F.array_compact(F.array(*found)))

            return let(amounts, read)

        return F.when(F.size(notes) >= 4, let(F.element_at(notes, -1), after))

    here = F.contains(line, F.lit("\t")) & F.contains(F.lower(line), F.lit("trade receiv"))
    return F.coalesce(F.when(here, let(cells, of)), F.array().cast(FOUND))


def _within(p: Column, key: str, low: float, high: float) -> Column:
    return F.when((p["closing"] > low) & (p["closing"] < high), F.struct(F.lit(key).alias("key"), p["opening"].alias("opening"), p["closing"].alias("closing")))


def face_line(line: Column) -> Column:
    """Components of a face line: label, note number and the first two amounts of five digits at least, closing first.

    Lines of more than 220 characters, totals and hypothecations have none."""
    low = F.lower(line)

    def of(v: Column) -> Column:
        def one(label: str, note: int, key: str, most: float) -> Column:
            here = F.rlike(low, F.lit(label)) & F.rlike(line, F.lit(rf"\b{note}\b")) & (F.get(v, F.lit(0)) <= most)
            if key == "face.loans_and_advances":
                here = here & F.contains(low, F.lit("other current"))
            return F.when(here, F.struct(F.lit(key).alias("key"), F.get(v, F.lit(1)).alias("opening"), F.get(v, F.lit(0)).alias("closing")))

        return F.when(F.size(v) >= 2, F.array_compact(F.array(*[one(*x) for x in FACE_LINES])))

    amounts = F.transform(F.filter(F.regexp_extract_all(line, F.lit(r"[\d,]+"), F.lit(0)), lambda t: F.length(F.regexp_replace(t, r"\D", "")) >= 5), numbers.clean_number)
    plain = (F.length(line) <= 220) & ~F.contains(low, F.lit("hypothecation")) & ~F.contains(low, F.lit("total"))
    return F.coalesce(F.when(plain, let(amounts, of)), F.array().cast(FOUND))


def face_components(page_text: DataFrame, table_text: str | None = None) -> DataFrame:
    """(doc_id, page_no, key, opening, closing) of balance sheet pages, from tabular rows and summary lines.

    Lines are read in their order, of the table engine's text first where there is one; on a line the tabular reading goes
    first, and the first reading of a component counts."""
    text = F.col("text")
    found = T.bodies(F.col(table_text) if table_text else F.lit(None).cast("string"), text)
    rows = page_text.where(F.rlike(F.lower(text), F.lit(r"balance\s+sheet\s+as\s+at")))
    lines = F.flatten(F.transform(found, lambda b: F.split(b["body"], "\n")))
    likely = F.filter(lines, lambda x: F.rlike(F.lower(x), F.lit(r"unsecured\s+loan|trade\s+receiv|loans?\s*[.&\s]*advan")))
    read = F.flatten(F.transform(likely, lambda x: F.concat(face_row(x), face_line(x))))
    first = F.aggregate(read, F.array().cast(FOUND), lambda acc, r: F.when(F.exists(acc, lambda a: a["key"] == r["key"]), acc).otherwise(F.concat(acc, F.array(r))))
    return rows.select("doc_id", "page_no", F.inline(first))
