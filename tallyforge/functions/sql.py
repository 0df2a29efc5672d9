"""The amount functions for SQL: defined in SQL, so that the optimiser puts their bodies into the query
(but not within lambdas, where SQL's functions can't be called).

``register_functions`` makes them temporary functions of a session: scalars for tokens and lines, and table functions
that turn a page into its lines or into candidates for a row (label, closing, opening)."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

#: Lines of a page that hold a label and two amounts from 1,000 on, in SQL.
CANDIDATES = """transform(filter(transform(split(coalesce(page, ''), '\\n'), (line, i) -> named_struct('i', i, 'v',
             if(contains(lower(line), label), filter(transform(filter(regexp_extract_all(line, '[0-9,.]+', 0), t -> t RLIKE '[0-9]'), t -> coalesce(try_cast(replace(t, ',', '') AS DOUBLE), 0D)), x -> x >= 1000D), array()))),
           c -> size(c.v) >= 2), c -> named_struct('line_no', c.i, 'closing', c.v[0], 'opening', c.v[1]))"""
#: name, parameters, result, body; later ones may call earlier ones.
SCALARS = (
    ("number_or_zero", "x STRING", "DOUBLE", "coalesce(try_cast(x AS DOUBLE), 0D)"),
    ("digit_groups", "x STRING", "ARRAY<STRING>", "filter(transform(split(x, ','), p -> regexp_replace(p, '[^0-9]', '')), p -> p <> '')"),
    (
        "indian_parse", "x STRING", "DOUBLE",
        """CASE WHEN x IS NULL OR replace(trim(x), ' ', '') IN ('', '-', '—') THEN 0D
             WHEN NOT contains(x, ',') THEN number_or_zero(regexp_replace(x, '[^0-9.]', ''))
             ELSE aggregate(transform(reverse(digit_groups(replace(trim(x), ' ', ''))), (p, i) -> coalesce(try_cast(p AS DOUBLE), 0D) * if(i = 0, 1D, pow(10D, 2 * i + 1))), 0D, (a, v) -> a + v) END""",
    ),
    ("indian_format", "x DOUBLE", "STRING", """CASE WHEN abs(x) < 1000 THEN cast(cast(abs(x) AS DECIMAL(20,0)) AS STRING)
             ELSE regexp_replace(left(cast(cast(abs(x) AS DECIMAL(20,0)) AS STRING), length(cast(cast(abs(x) AS DECIMAL(20,0)) AS STRING)) - 3), '(?<=[0-9])(?=([0-9][0-9])+$)', ',') || ',' || right(cast(cast(abs(x) AS DECIMAL(20,0)) AS STRING), 3) END"""),
    ("clean_number", "x STRING", "DOUBLE", "CASE WHEN x IS NULL THEN 0D WHEN contains(x, ',') AND size(digit_groups(x)) >= 2 THEN indian_parse(x) ELSE number_or_zero(regexp_replace(regexp_replace(trim(x), '[, ]', ''), '-', '0')) END"),
    ("signed_amount", "x STRING", "DOUBLE", "if(trim(x) RLIKE '^[-(]', -1D, 1D) * indian_parse(regexp_replace(x, '[()-]', ''))"),
    (
        "parse_number", "x STRING", "DOUBLE",
        """CASE WHEN x IS NULL THEN NULL WHEN upper(trim(x)) IN ('', '-', '--', '—', 'NIL', 'NA', 'N/A', 'N.A.') THEN 0D
             ELSE if(trim(x) RLIKE '^[(].*[)]$' OR trim(x) RLIKE '^-[^-]', -1D, 1D) * try_cast(regexp_replace(x, '[^0-9.]', '') AS DOUBLE) END""",
    ),
    ("unit_multiplier", "unit STRING", "DOUBLE", "CASE unit WHEN 'crores' THEN 10000000D WHEN 'lakhs' THEN 100000D ELSE 1D END"),
    (
        "unit_of", "page STRING", "STRING",
        """CASE WHEN page IS NULL THEN 'rupees'
             WHEN replace(lower(page), ' ', '') RLIKE 'amounts?\\\\s*in\\\\s*crores?|in\\\\s*crores?|in\\\\s*cr\\\\b' THEN 'crores'
             WHEN replace(lower(page), ' ', '') RLIKE 'amounts?\\\\s*(in|m)\\\\s*lacs?|in\\\\s*(lacs?|lakhs?)' THEN 'lakhs'
             WHEN contains(replace(lower(page), ' ', ''), 'netblock') AND contains(replace(lower(page), ' ', ''), 'grossblock') THEN 'rupees'
             WHEN replace(lower(page), ' ', '') RLIKE 'property[,.]plant' AND contains(lower(page), 'schedule') AND replace(lower(page), ' ', '') RLIKE 'lacs?|lakhs?' THEN 'lakhs'
             ELSE 'rupees' END""",
    ),
    ("line_tokens", "line STRING", "ARRAY<STRING>", "filter(regexp_extract_all(coalesce(line, ''), '[0-9,.]+', 0), t -> t RLIKE '[0-9]')"),
    ("plain_amounts", "line STRING", "ARRAY<DOUBLE>", "filter(transform(line_tokens(line), t -> coalesce(try_cast(replace(t, ',', '') AS DOUBLE), 0D)), v -> v >= 1000D AND v NOT IN (2022D, 2023D, 2024D, 2025D) AND v NOT BETWEEN 12020D AND 12030D)"),
    (
        "candidate_rows", "page STRING, label STRING", "ARRAY<STRUCT<line_no: INT, closing: DOUBLE, opening: DOUBLE>>",
        CANDIDATES,
    ),
)
#: Their bodies are one generator over the page, so that a lateral join with them is that generator and no join.
#: name, parameters, columns, body.
TABLES = (
    ("page_lines", "page STRING", "line_no INT, line STRING", "SELECT pos, col FROM posexplode(split(coalesce(page, ''), '\\n'))"),
    ("page_candidates", "page STRING, label STRING", "line_no INT, closing DOUBLE, opening DOUBLE", f"SELECT line_no, closing, opening FROM inline({CANDIDATES})"),
)


def register_functions(spark: SparkSession, prefix: str = "") -> list[str]:
    """Make the functions known to a session's SQL, with a prefix to their names; returns these."""
    names = [name for name, *_ in SCALARS]

    def own(body: str) -> str:
        return re.sub(rf"\b({'|'.join(names)})\(", rf"{prefix}\1(", body)

    for name, parameters, result, body in SCALARS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({parameters}) RETURNS {result} RETURN {own(body)}")
    for name, parameters, columns, body in TABLES:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({parameters}) RETURNS TABLE ({columns}) RETURN {own(body)}")
    return [prefix + n for n in (*names, *(t[0] for t in TABLES))]
