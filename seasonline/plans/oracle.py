"""The same queries as plain SQL over the same tables, for checking results on another engine."""

from __future__ import annotations

_LINE = """line AS (
  SELECT l_partkey AS name, p_brand AS pos, CAST(year(l_shipdate) AS INTEGER) AS yr,
         CAST(count(DISTINCT month(l_shipdate)) AS INTEGER) AS gp, sum(l_quantity) AS qty, count(*) AS lines,
         sum(l_quantity * p_retailprice) AS proj, sum(l_extendedprice * (1 - l_discount)) AS act
  FROM lineitem JOIN part ON l_partkey = p_partkey
  GROUP BY l_partkey, p_brand, year(l_shipdate))"""

_ADJ = (
    _LINE
    + """,
adj AS (
  SELECT name, pos, yr, gp, qty, lines, proj, act, 12.0::DOUBLE / gp * act AS a,
         abs(12.0::DOUBLE / gp * act - proj) AS e
  FROM line WHERE gp > 3)"""
)


def _midpoints(source: str, value: str, qs: dict[str, float], group: str | None = None) -> str:
    """CTEs that give midpoint quantiles by row number."""
    part = f"PARTITION BY {group}" if group else ""
    head = f"{group}, " if group else ""
    picks = ", ".join(
        f"(max(v) FILTER (WHERE rn = floor((n - 1) * {q})) + max(v) FILTER (WHERE rn = ceil((n - 1) * {q}))) / 2 AS {name}"
        for name, q in qs.items()
    )
    return f"""ranked AS (
  SELECT {head}{value} AS v, row_number() OVER ({part} ORDER BY {value}) - 1 AS rn, count(*) OVER ({part}) AS n
  FROM {source}),
quart AS (SELECT {head}max(n) AS n, {picks} FROM ranked {"GROUP BY " + group if group else ""})"""


_QUART = _midpoints("adj", "e", {"q25": 0.25, "q75": 0.75}, "pos")
_LETTERS = "translate(CAST({} AS VARCHAR), '0123456789', 'ABCDEFGHIJ')"
_NAME = _LETTERS.format("name")
_KIND = "CASE WHEN url LIKE '%/es/%' THEN 'es' WHEN url LIKE '%/de/%' THEN 'de' WHEN url LIKE '%/fr/%' THEN 'fr' WHEN url LIKE '%/en/%' THEN 'en' END"

_FACETS = f"""SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host, {_KIND} AS kind,
  nullif(regexp_extract(regexp_replace(url, '^[a-z]+://[^/]+', ''), '^[^?#0-9]*([0-9]+)', 1), '') AS item,
  TRY_CAST(nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS INTEGER) AS page,
  nullif(regexp_extract(url, '[?&]ref=([^&#]*)', 1), '') AS ref,
  nullif(regexp_extract(url, '[?&]utm_source=([^&#]*)', 1), '') AS utm_source
FROM pages"""

_SIDES = """sides AS (
  SELECT 'projected' AS kind, name, pos, yr, gp, qty, lines, round(proj, 2) AS points FROM line
  UNION ALL
  SELECT 'actual' AS kind, name, pos, yr, gp, qty, lines, round(act, 4) AS points FROM line)"""

_TRAIN = (
    "WITH "
    + _ADJ.replace("FROM line WHERE gp > 3", "FROM line WHERE gp > 3 AND yr < 2001")
    + ",\n"
    + _QUART
    + """,
train AS (SELECT adj.* FROM adj JOIN quart USING (pos) WHERE e <= 1.5 * (q75 - q25))"""
)


# The two sides, each without some names and with others twice.
_UNEVEN = """forecast AS (
  SELECT l_partkey AS name, p_brand AS pos, CAST(year(l_shipdate) AS INTEGER) AS yr, copy, sum(l_quantity) AS qty,
         count(*) AS lines, sum(l_quantity) * p_retailprice AS proj
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN (SELECT unnest([1, 2]) AS copy) ON copy = 1 OR l_partkey % 7 = 0
  WHERE l_partkey % 11 <> 0 GROUP BY l_partkey, p_brand, p_retailprice, year(l_shipdate), copy),
outcome AS (
  SELECT l_partkey AS name, CAST(year(l_shipdate) AS INTEGER) AS yr, copy,
         CAST(count(DISTINCT month(l_shipdate)) AS INTEGER) AS gp, sum(l_extendedprice * (1 - l_discount)) AS act
  FROM lineitem JOIN (SELECT unnest([1, 2]) AS copy) ON copy = 1 OR l_partkey % 5 = 0
  WHERE l_partkey % 13 <> 0 GROUP BY l_partkey, year(l_shipdate), copy)"""


def _hist(by: str, values: dict[str, str], bins: int) -> str:
    head = f"{by}, " if by else ""
    long = " UNION ALL ".join(f"SELECT {head}'{s}' AS stat, {x} AS x FROM line" for s, x in values.items())
    return f"""x AS ({long}),
edges AS (SELECT {head}stat, min(x) AS lo, max(x) AS hi, count(x) AS total FROM x GROUP BY {head}stat),
bins AS (
  SELECT {head}stat, lo, hi, total,
         CASE WHEN hi > lo THEN CAST(least(floor((x - lo) / (hi - lo) * {bins}), {bins - 1}) AS INTEGER) ELSE 0 END AS bin,
         count(*) AS n
  FROM x JOIN edges USING ({head}stat) WHERE x IS NOT NULL GROUP BY ALL)"""


# Gram matrix of two centred, scaled features, solved by hand.
_RIDGE = (
    _TRAIN
    + """,
m AS (SELECT pos, avg(gp) AS g_m, stddev_pop(gp) AS g_s, avg(proj) AS p_m, stddev_pop(proj) AS p_s FROM train GROUP BY pos),
scaled AS (
  SELECT pos, (gp - g_m) / CASE WHEN g_s = 0 THEN 1 ELSE g_s END AS x1,
         (proj - p_m) / CASE WHEN p_s = 0 THEN 1 ELSE p_s END AS x2, a
  FROM train JOIN m USING (pos)),
means AS (SELECT pos, avg(x1) AS m1, avg(x2) AS m2, avg(a) AS ma FROM scaled GROUP BY pos),
sums AS (
  SELECT pos, m1, m2, ma, sum((x1 - m1) * (x1 - m1)) + 0.5 AS s11, sum((x1 - m1) * (x2 - m2)) AS s12,
         sum((x2 - m2) * (x2 - m2)) + 0.5 AS s22, sum((x1 - m1) * (a - ma)) AS b1, sum((x2 - m2) * (a - ma)) AS b2
  FROM scaled JOIN means USING (pos) GROUP BY pos, m1, m2, ma),
model AS (
  SELECT pos, m1, m2, ma, (b1 * s22 - b2 * s12) / (s11 * s22 - s12 * s12) AS w1,
         (b2 * s11 - b1 * s12) / (s11 * s22 - s12 * s12) AS w2
  FROM sums)
SELECT pos, name AS player, round(proj, 4) AS projection,
       round(ma + w1 * ((12 - g_m) / CASE WHEN g_s = 0 THEN 1 ELSE g_s END - m1)
                + w2 * ((proj - p_m) / CASE WHEN p_s = 0 THEN 1 ELSE p_s END - m2), 3) AS score
FROM line LEFT JOIN m USING (pos) LEFT JOIN model USING (pos) WHERE yr = 2001"""
)

# Two hidden units for each run, then the same system as above.
_PAIR = (
    _TRAIN
    + """,
m AS (SELECT pos, avg(gp) AS g_m, stddev_pop(gp) AS g_s, avg(proj) AS p_m, stddev_pop(proj) AS p_s FROM train GROUP BY pos),
layer AS (
  SELECT CAST(run AS INTEGER) AS run,
         sin(1.3 * (run + 1) + 2.1 + 3.7) AS w11, sin(1.3 * (run + 1) + 4.2 + 3.7) AS w21, sin(0.7 * (run + 1) + 1.9) AS c1,
         sin(1.3 * (run + 1) + 2.1 + 7.4) AS w12, sin(1.3 * (run + 1) + 4.2 + 7.4) AS w22, sin(0.7 * (run + 1) + 3.8) AS c2
  FROM range(0, 3) t(run)),
inputs AS (
  SELECT 'train' AS part, pos, name, proj, a, (gp - g_m) / CASE WHEN g_s = 0 THEN 1 ELSE g_s END AS x1,
         (proj - p_m) / CASE WHEN p_s = 0 THEN 1 ELSE p_s END AS x2 FROM train JOIN m USING (pos)
  UNION ALL
  SELECT 'coming', line.pos, name, proj, NULL, (12 - g_m) / CASE WHEN g_s = 0 THEN 1 ELSE g_s END,
         (proj - p_m) / CASE WHEN p_s = 0 THEN 1 ELSE p_s END FROM line LEFT JOIN m ON line.pos = m.pos WHERE yr = 2001),
h AS (
  SELECT part, pos, name, proj, a, run, CASE WHEN x1 IS NOT NULL THEN greatest(x1 * w11 + x2 * w21 + c1, 0) END AS h1,
         CASE WHEN x1 IS NOT NULL THEN greatest(x1 * w12 + x2 * w22 + c2, 0) END AS h2
  FROM inputs, layer),
means AS (SELECT pos, run, avg(h1) AS m1, avg(h2) AS m2, avg(a) AS ma FROM h WHERE part = 'train' GROUP BY pos, run),
sums AS (
  SELECT pos, run, m1, m2, ma, sum((h1 - m1) * (h1 - m1)) + 10 AS s11, sum((h1 - m1) * (h2 - m2)) AS s12,
         sum((h2 - m2) * (h2 - m2)) + 10 AS s22, sum((h1 - m1) * (a - ma)) AS b1, sum((h2 - m2) * (a - ma)) AS b2
  FROM h JOIN means USING (pos, run) WHERE part = 'train' GROUP BY pos, run, m1, m2, ma),
scores AS (
  SELECT h.pos, name AS player, h.run, proj, ma + (b1 * s22 - b2 * s12) / (s11 * s22 - s12 * s12) * (h1 - m1)
         + (b2 * s11 - b1 * s12) / (s11 * s22 - s12 * s12) * (h2 - m2) AS score
  FROM h LEFT JOIN sums ON h.pos = sums.pos AND h.run = sums.run WHERE part = 'coming')"""
)

# Season files: five features and three hidden units; the system of three is solved by determinants.
_FILE_STATS = "name, pos, gp, qty AS rec, round(round(proj, 2) / qty, 2) AS rec_yds, CAST(lines AS DOUBLE) AS rec_tds, round(proj, 2) AS p"
_FILE_TRAIN = f"""WITH {_LINE},
adj AS (
  SELECT yr, {_FILE_STATS}, 12.0::DOUBLE / gp * round(act, 4) AS a, abs(12.0::DOUBLE / gp * round(act, 4) - round(proj, 2)) AS e
  FROM line WHERE gp > 3 AND yr BETWEEN 1996 AND 2000),
{_midpoints("adj", "e", {"q25": 0.25, "q75": 0.75})},
train AS (SELECT adj.* FROM adj, quart WHERE e <= 1.5 * (q75 - q25))"""


def _file_scores() -> str:
    inputs = ["gp", "rec", "rec_yds", "rec_tds", "p"]
    units = (1, 2, 3)
    moments = ", ".join(f"avg({c}) AS {c}_m, stddev_pop({c}) AS {c}_s" for c in inputs)
    scaled = ", ".join(f"(x.{c} - {c}_m) / CASE WHEN {c}_s = 0 THEN 1 ELSE {c}_s END AS {c}" for c in inputs)

    def unit(u: int) -> str:
        terms = " + ".join(f"{c} * sin(1.3 * (run + 1) + {2.1 * f!r} + {3.7 * u!r})" for f, c in enumerate(inputs, 1))
        return f"greatest({terms} + sin(0.7 * (run + 1) + {1.9 * u!r}), 0) AS h{u}"

    means = ", ".join(f"avg(h{u}) AS m{u}" for u in units)
    cross = ", ".join(
        f"sum((h{u} - m{u}) * (h{v} - m{v})){' + 10' if u == v else ''} AS s{u}{v}" for u in units for v in units if u <= v
    )
    right = ", ".join(f"sum((h{u} - m{u}) * (a - ma)) AS b{u}" for u in units)

    def determinant(column: int | None) -> str:
        cell = lambda i, j: f"b{i}" if j == column else f"s{min(i, j)}{max(i, j)}"
        turns = [(1, 2, 3), (2, 3, 1), (3, 1, 2)], [(1, 3, 2), (2, 1, 3), (3, 2, 1)]
        plus, minus = (" + ".join("*".join(cell(i, j) for i, j in zip(units, t, strict=True)) for t in some) for some in turns)
        return f"(({plus}) - ({minus}))"

    weights = ", ".join(f"{determinant(u)} / {determinant(None)} AS w{u}" for u in units)
    score = " + ".join(f"w{u} * (h{u} - m{u})" for u in units)
    return f"""{_FILE_TRAIN},
moments AS (SELECT {moments} FROM train),
rows AS (
  SELECT 'train' AS part, name, yr, p AS projection, a, {scaled} FROM train x, moments
  UNION ALL SELECT 'coming', name, yr, p, NULL, {scaled}
  FROM (SELECT yr, {_FILE_STATS.replace("gp,", "12 AS gp,")} FROM line WHERE yr = 2001) x, moments),
h AS (SELECT part, name, yr, projection, a, run, {", ".join(unit(u) for u in units)} FROM rows, (SELECT CAST(run AS INTEGER) AS run FROM range(0, 3) t(run))),
means AS (SELECT run, {means}, avg(a) AS ma FROM h WHERE part = 'train' GROUP BY run),
sums AS (SELECT run, {", ".join(f"m{u}" for u in units)}, ma, {cross}, {right} FROM h JOIN means USING (run) WHERE part = 'train' GROUP BY ALL),
model AS (SELECT *, {weights} FROM sums)
SELECT yr, 'TE' AS pos, run, {_NAME} AS player, round(projection, 4) AS projection, round(ma + {score}, 2) AS score
FROM h JOIN model USING (run) WHERE part = 'coming'"""


_SKEW = (
    "WITH "
    + _LINE
    + """,
x AS (SELECT pos, 'qty' AS stat, qty AS v FROM line UNION ALL SELECT pos, 'proj', proj FROM line
      UNION ALL SELECT pos, 'act', act FROM line),
c AS (SELECT pos, stat, v - avg(v) OVER (PARTITION BY pos, stat) AS d FROM x),
g AS (SELECT pos, stat, count(*) AS n, CAST(count(*) AS DOUBLE) AS k,
             avg(d * d * d) / pow(avg(d * d), 1.5) AS skewness FROM c GROUP BY pos, stat),
t AS (SELECT *, skewness * sqrt((k + 1) * (k + 3) / (6 * (k - 2))) AS y,
        3 * (k * k + 27 * k - 70) * (k + 1) * (k + 3) / ((k - 2) * (k + 5) * (k + 7) * (k + 9)) AS b2 FROM g),
u AS (SELECT *, sqrt(2 * (b2 - 1)) - 1 AS w2 FROM t),
s AS (SELECT *, ln(y / sqrt(2 / (w2 - 1)) + sqrt(pow(y / sqrt(2 / (w2 - 1)), 2) + 1)) / sqrt(0.5 * ln(w2)) AS z FROM u),
e AS (SELECT *, abs(z) / sqrt(2.0) AS h FROM s)
SELECT pos, stat, n, round(skewness, 6) AS skewness, round(z, 6) AS z,
       round(greatest(0.0, 1 - list_sum(
             [exp((2 * i + 1) * ln(greatest(h, 1e-300)) - h * h - lgamma(i + 1.5)) for i in range(0, 1000)])), 6) AS p_value
FROM e"""
)

# Of each page the newest load counts; the second sets some pages and records right.
_HISTORY = f"""WITH {_LINE},
{_SIDES},
fetched AS (
  SELECT 1 AS load, kind, name, yr, CAST(name // 50 AS INTEGER) AS page, qty, points FROM sides
  UNION ALL SELECT 2, kind, name, yr, CAST(name // 50 AS INTEGER), qty * 2, points FROM sides
  WHERE yr IN (1996, 1997) AND (name // 50) % 2 = 0),
records AS (SELECT *, NOT (load = 2 AND yr = 1997) AS faulty, name = max(name) OVER (PARTITION BY load, kind, yr, page) AS is_last,
                   load = max(load) OVER (PARTITION BY kind, yr, page) AS newest FROM fetched),
current AS (SELECT *, page % 7 = 5 AND faulty AS no_table, is_last AND faulty AS short FROM records WHERE newest),
kept AS (SELECT * FROM current WHERE page % 7 <> 3 AND NOT no_table AND NOT (load = 2 AND yr = 1996 AND page = 0))
SELECT 'stored' AS status, kind, yr, page, {_NAME} AS name, points, qty FROM kept WHERE NOT short
UNION ALL SELECT 'record', kind, yr, page, {_NAME}, NULL, NULL FROM kept WHERE short
UNION ALL SELECT CASE page % 7 WHEN 3 THEN 'unknown page' ELSE 'no table' END, kind, yr, page, NULL, NULL, NULL
FROM (SELECT DISTINCT kind, yr, page FROM current WHERE page % 7 = 3 OR no_table)"""

ORACLE_SQL: dict[str, str] = {
    "trimmed_reconciliation": f"""WITH {_ADJ},
{_QUART}
SELECT name, pos, yr, gp, round(proj, 4) AS proj, round(a, 6) AS a, round(e, 6) AS e
FROM adj JOIN quart USING (pos) WHERE e <= 1.5 * (q75 - q25)""",
    "forecast_actual_join": f"""WITH {_UNEVEN}
SELECT f.name, f.pos, f.yr, f.copy, o.gp, f.qty, f.lines, round(f.proj, 4) AS proj, round(o.act * o.copy, 4) AS act
FROM forecast f JOIN outcome o ON f.name = o.name AND f.yr = o.yr""",
    "loose_name_join": f"""WITH {_UNEVEN},
f AS (SELECT *, {_NAME} || CASE WHEN name % 2 = 0 THEN ' Jr.' ELSE '' END AS shown FROM forecast),
o AS (SELECT *, {_NAME} || CASE WHEN name % 2 = 0 THEN ' Jr' ELSE '. ' END AS shown FROM outcome)
SELECT f.pos, f.shown AS name, f.yr, o.gp, round(f.proj, 4) AS proj, round(o.act, 4) AS act
FROM f JOIN o ON trim(replace(f.shown, '.', '')) = trim(replace(o.shown, '.', '')) AND f.yr = o.yr""",
    "exposure_rescale": f"""WITH {_ADJ}
SELECT name, pos, yr, gp, round(act, 4) AS act, round(a, 6) AS a FROM adj WHERE yr BETWEEN 1996 AND 1999""",
    "tukey_fence": f"""WITH {_ADJ},
{_QUART}
SELECT name, pos, yr, round(e, 6) AS e FROM adj JOIN quart USING (pos) WHERE e <= q75 + 1.5 * (q75 - q25)""",
    "std_fence": f"""WITH {_ADJ},
lim AS (SELECT pos, 2 * stddev_pop(e) AS fence FROM adj GROUP BY pos)
SELECT name, pos, yr, round(e, 6) AS e FROM adj JOIN lim USING (pos) WHERE e <= fence""",
    "midpoint_quartiles": f"""WITH {_ADJ},
{_QUART}
SELECT pos, n, round(q25, 7) AS q25, round(q75, 7) AS q75, round(q75 - q25, 7) AS iqr,
       round(1.5 * (q75 - q25), 7) AS fence FROM quart""",
    "overall_quartiles": f"""WITH {_midpoints("lineitem", "l_extendedprice", {"q25": 0.25, "q50": 0.5, "q75": 0.75})}
SELECT n, round(q25, 7) AS q25, round(q50, 7) AS q50, round(q75, 7) AS q75 FROM quart""",
    "duplicate_keys": """SELECT o_custkey AS name, CAST(year(o_orderdate) AS INTEGER) AS yr, count(*) AS n_rows
FROM orders GROUP BY 1, 2 HAVING count(*) > 1""",
    "season_zscore": "WITH "
    + _LINE
    + "\nSELECT name, pos, yr, "
    + ", ".join(
        f"round(coalesce(({c} - avg({c}) OVER w) / nullif(stddev_samp({c}) OVER w, 0), 0), 6) AS z_{c}"
        for c in ("gp", "qty", "lines", "proj", "act")
    )
    + " FROM line WINDOW w AS (PARTITION BY yr)",
    "feature_scores": "WITH "
    + _LINE
    + "\nSELECT "
    + ", ".join(
        f"round(coalesce(({c} - avg({c}) OVER w) / nullif(stddev_samp({c}) OVER w, 0), 0), 6) AS {c}"
        for c in ("gp", "qty", "lines", "proj", "act")
    )
    + " FROM line WINDOW w AS (PARTITION BY yr)",
    "pop_scaler": f"""WITH {_LINE},
s AS (SELECT avg(proj) AS pm, stddev_pop(proj) AS ps, avg(act) AS am, stddev_pop(act) AS asd FROM line WHERE yr < 2001)
SELECT name, pos, yr, round((proj - pm) / ps, 6) AS s_proj, round((act - am) / asd, 6) AS s_act FROM line, s""",
    "error_report": f"""WITH {_ADJ}
SELECT pos, count(*) AS n, round(avg(a - proj), 3) AS proj_mean_error, round(stddev_pop(a - proj), 3) AS proj_std_error,
       round(sqrt(avg((a - proj) * (a - proj))), 3) AS proj_rmse, round(avg(a - act), 3) AS raw_mean_error,
       round(stddev_pop(a - act), 3) AS raw_std_error, round(sqrt(avg((a - act) * (a - act))), 3) AS raw_rmse
FROM adj GROUP BY pos""",
    "skew_report": _SKEW,
    "stat_histogram": f"""WITH {_LINE},
{_hist("pos", {"proj": "proj", "act": "act"}, 30)}
SELECT pos, stat, bin, n, round(lo + (hi - lo) / 30 * bin, 7) AS low, round(lo + (hi - lo) / 30 * (bin + 1), 7) AS high,
       CASE WHEN hi > lo THEN round(n / (total * ((hi - lo) / 30)), 9) END AS density FROM bins""",
    "log_histogram": f"""WITH {_LINE},
{_hist("", {"act": "CASE WHEN act > 0 THEN ln(act) END"}, 20)}
SELECT stat, bin, n, round(lo + (hi - lo) / 20 * bin, 6) AS low, round(lo + (hi - lo) / 20 * (bin + 1), 6) AS high FROM bins""",
    "conform_layouts": f"""WITH {_LINE},
{_SIDES}
SELECT kind, {_NAME} AS name, pos AS team, yr,
       CASE WHEN kind = 'projected' AND lines % 2 = 1 THEN CAST(gp AS INTEGER) END AS bye,
       CASE WHEN kind = 'actual' THEN CAST(gp AS INTEGER) END AS gp, qty, CAST(lines AS DOUBLE) AS lines, points FROM sides""",
    "scoring_frame": f"""WITH {_LINE}
SELECT {_NAME} AS name, 12 AS gp, qty, round(proj, 2) AS points FROM line WHERE yr = 2001""",
    "union_seasons": f"""WITH {_LINE}
SELECT 'projected' AS kind, name, pos, yr, round(proj, 4) AS proj, NULL::INTEGER AS gp, NULL::DOUBLE AS act FROM line
UNION ALL SELECT 'actual', l_partkey, NULL, CAST(year(l_shipdate) AS INTEGER), NULL,
  CAST(count(DISTINCT month(l_shipdate)) AS INTEGER), round(sum(l_extendedprice * (1 - l_discount)), 4)
FROM lineitem GROUP BY l_partkey, year(l_shipdate)""",
    "sink_roundtrip": f"""WITH {_LINE},
{_SIDES}
SELECT 'seasons' AS sink, * FROM sides
UNION ALL SELECT 'master' AS sink, * FROM sides WHERE yr BETWEEN 1996 AND 1998
UNION ALL SELECT 'scores' AS sink, * FROM sides WHERE yr = 2001""",
    "url_facets": _FACETS,
    "incremental_pages": _FACETS,
    "page_cells": r"""WITH c AS (
  SELECT page_id, regexp_extract_all(html, '<a [^>]*>(.*?)</a>', 1, 's') AS cells FROM pages),
x AS (SELECT page_id, unnest(cells) AS body, unnest(range(0, len(cells))) AS cell_no FROM c)
SELECT page_id, CAST(cell_no AS INTEGER) AS cell_no, replace(trim(replace(body, '&amp;', '&')), ',', '') AS text FROM x""",
    "page_element": """WITH b AS (SELECT page_id, regexp_extract(html, '<div class="ad">.*?</div>', 0, 's') AS block FROM pages)
SELECT page_id, block,
       replace(trim(replace(regexp_replace(block, '<[^>]*>', '', 'g'), '&amp;', '&')), ',', '') AS text FROM b""",
    "page_quality": f"""SELECT {_KIND} AS kind, count(*) AS n_pages,
       count(*) FILTER (WHERE html NOT LIKE '%<html lang="en">%' OR len(regexp_extract_all(html, '<a [^>]*>')) <= 1) AS n_empty,
       count(*) FILTER (WHERE html NOT LIKE '%<html lang="en">%') AS n_missing,
       CAST(coalesce(sum(CASE WHEN html LIKE '%<html lang="en">%' THEN len(regexp_extract_all(html, '<a [^>]*>')) ELSE 0 END), 0) AS BIGINT) AS n_cells
FROM pages GROUP BY 1""",
    "page_quarantine": """SELECT page_id, url FROM pages WHERE html NOT LIKE '%<html lang="en">%'""",
    "records_from_cells": f"""WITH {_LINE},
{_SIDES}
SELECT kind, {_NAME} AS name, pos AS team, yr, CASE WHEN kind = 'projected' THEN CAST(gp AS INTEGER) END AS bye,
       CASE WHEN kind = 'actual' THEN CAST(gp AS INTEGER) END AS gp, qty, CAST(lines AS DOUBLE) AS lines, points FROM sides""",
    "season_files": f"""WITH {_LINE},
{_SIDES}
SELECT kind, {_NAME} AS name, pos AS team, yr, CASE WHEN kind = 'projected' THEN CAST(gp AS INTEGER) END AS bye,
       CASE WHEN kind = 'actual' THEN CAST(gp AS INTEGER) END AS gp, qty, CAST(lines AS DOUBLE) AS lines, points,
       NULL::VARCHAR AS reason, NULL::VARCHAR AS raw FROM sides WHERE name % 41 <> 7
UNION ALL SELECT kind, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'wrong width', {_NAME} || ',' || pos FROM sides WHERE name % 41 = 7""",
    "table_grid": f"""WITH {_LINE},
r AS (SELECT *, name // 50 AS page, row_number() OVER (PARTITION BY yr, name // 50 ORDER BY name) AS row_no FROM line),
p AS (SELECT DISTINCT yr, page FROM r),
cells AS (
  SELECT yr, page, row_no, false AS is_header,
         [{_NAME}, pos, CAST(gp AS VARCHAR), format('{{:,}}', CAST(qty AS BIGINT)), format('{{:,.2f}}', round(proj, 2))] AS texts FROM r
  UNION ALL SELECT yr, page, 0, true, ['Name', 'Team', 'Months', 'Qty', 'Value'] FROM p
  UNION ALL SELECT yr, page, max(row_no) + 1, true, ['Sum', 'Sum', 'Sum', 'Sum', 'Sum'] FROM r GROUP BY yr, page
  UNION ALL SELECT yr, page, max(row_no) + 2, false, ['All & more', 'All & more', 'n', 'x', 'x'] FROM r GROUP BY yr, page
  UNION ALL SELECT yr, page, max(row_no) + 3, false, ['All & more', 'All & more', 'm', 'y', 'z', 'extra'] FROM r GROUP BY yr, page)
SELECT yr, CAST(page AS INTEGER) AS page, CAST(row_no AS INTEGER) AS row_no, CAST(unnest(range(0, len(texts))) AS INTEGER) AS col_no,
       is_header, unnest(texts) AS text FROM cells""",
    "grid_sink_roundtrip": f"""WITH {_LINE},
ends AS (SELECT yr, CAST(name // 50 AS INTEGER) AS page, CAST(count(*) AS INTEGER) AS n FROM line GROUP BY ALL)
SELECT yr, CAST(name // 50 AS INTEGER) AS page,
       CAST(row_number() OVER (PARTITION BY yr, name // 50 ORDER BY name) AS INTEGER) AS row_no,
       {_NAME} AS name, pos AS team, CAST(gp AS VARCHAR) AS months, format('{{:,}}', CAST(qty AS BIGINT)) AS qty,
       format('{{:,.2f}}', round(proj, 2)) AS value, '' AS extra FROM line
UNION ALL SELECT yr, page, n + 1, 'Sum', 'Sum', 'Sum', 'Sum', 'Sum', '' FROM ends
UNION ALL SELECT yr, page, n + 2, 'All & more', 'All & more', 'n', 'x', 'x', '' FROM ends
UNION ALL SELECT yr, page, n + 3, 'All & more', 'All & more', 'm', 'y', 'z', 'extra' FROM ends""",
    "grid_numbers": f"""WITH {_LINE}
SELECT yr, CAST(name // 50 AS INTEGER) AS page, CAST(row_number() OVER (PARTITION BY yr, name // 50 ORDER BY name) AS INTEGER) AS row_no,
       {_NAME} AS name, pos AS team, CAST(gp AS DOUBLE) AS months, CAST(qty AS DOUBLE) AS qty, round(proj, 2) AS value FROM line""",
    "ols_by_group": f"""WITH {_ADJ}
SELECT pos, count(*) AS n, round(regr_slope(a, proj), 6) AS slope, round(regr_intercept(a, proj), 3) AS intercept
FROM adj GROUP BY pos""",
    "ridge_scores": _RIDGE,
    "relu_pair_scores": _PAIR + "\nSELECT pos, player, run, round(proj, 4) AS projection, round(score, 2) AS score FROM scores",
    "relu_pair_summary": _PAIR
    + "\nSELECT pos, player, round(avg(score), 2) AS score_mean, round(stddev_samp(score), 2) AS score_std, count(score) AS n_runs"
    + " FROM scores GROUP BY pos, player",
    "training_rows": f"""{_FILE_TRAIN}
SELECT {_NAME} AS name, pos AS team, yr, gp, rec, rec_yds, rec_tds, p AS forecast, round(a, 6) AS outcome FROM train""",
    "file_run_scores": _file_scores(),
    "page_history": _HISTORY,
    "incremental_history": _HISTORY,
}
