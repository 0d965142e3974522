"""Equivalent SQL of every registered query, written for DuckDB over the
same parquet tables. The SQL is an independent statement of each result
(no shared code with the Spark plans): brute-force joins, windows with
full counts, plain CROSS JOINs where a one-row table is needed."""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from knnrec.plans import params as p

LO = "CAST(1 AS DOUBLE)"


def snap_sql(x: str) -> str:
    return f"(sign({x}) * floor(abs({x}) * 1e9 + 0.5) / 1e9)"


HI = "CAST(5 AS DOUBLE)"


def scale_sql(x: str, avg: str) -> str:
    return (f"(CASE WHEN {x} > {avg} THEN {HI} - {avg} "
            f"WHEN {x} < {avg} THEN {avg} - {LO} ELSE CAST(1 AS DOUBLE) END)")


RATINGS = """
ratings_raw AS (
  SELECT o_custkey AS u, l_partkey AS i, l_quantity AS q
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
ratings AS (
  SELECT u, i, CAST(1 + floor((sum(q) / count(*) - 1) / 10) AS DOUBLE) AS r
  FROM ratings_raw GROUP BY u, i),
train AS (SELECT u, i, r FROM ratings WHERE (u * 31 + i * 17) % 5 <> 0),
test AS (SELECT u, i, r FROM ratings WHERE (u * 31 + i * 17) % 5 = 0)"""

STATS = """
user_stats AS (
  SELECT u, sum(r) / count(*) AS avg_rating, count(*) AS n, sum(r) AS total
  FROM train GROUP BY u),
gstats AS (
  SELECT sum(total) / sum(n) AS global_avg, CAST(count(*) AS BIGINT) AS n_users
  FROM user_stats)"""

DEVS = f"""
devs AS (
  SELECT t.u, t.i, (t.r - s.avg_rating) / {scale_sql('t.r', 's.avg_rating')} AS dev
  FROM train t JOIN user_stats s ON t.u = s.u),
norms AS (SELECT u, sqrt(sum(dev * dev)) AS norm FROM devs GROUP BY u),
unit AS (
  SELECT d.u, d.i, d.dev / n.norm AS w
  FROM devs d JOIN norms n ON d.u = n.u WHERE n.norm > 0)"""

SIMS = """
half AS (
  SELECT u, v, sim FROM (
    SELECT a.u AS u, b.u AS v, """ + snap_sql("sum(a.w * b.w)") + """ AS sim
    FROM unit a JOIN unit b ON a.i = b.i AND a.u < b.u
    GROUP BY a.u, b.u) x
  WHERE sim <> 0),
sims AS (SELECT u, v, sim FROM half UNION ALL SELECT v AS u, u AS v, sim FROM half)"""


def slot_topk_sql(name: str, src: str, keys: str, k: int) -> str:
    """Slot rule: ``keys`` is a prefix like ``level, part,`` (may be empty)."""
    return f"""
{name}_ranked AS (
  SELECT {keys} u, v, sim,
         row_number() OVER (PARTITION BY {keys} u ORDER BY sim DESC, v) AS rn,
         count(*) OVER (PARTITION BY {keys} u) AS cnt
  FROM {src}),
{name} AS (
  SELECT {keys} u, v, sim, CAST(slot AS BIGINT) AS rank FROM (
    SELECT x.*, CASE WHEN sim > 0 THEN rn ELSE rn + (g.n_users - 1 - cnt) END AS slot
    FROM {name}_ranked x CROSS JOIN gstats g) y
  WHERE rn <= {k} AND slot <= {k})"""


def predict_sql(nb: str, pairs: str, keys: str = "", on_keys: str = "") -> str:
    """``pred(keys..., u, i, r, prediction)`` plus the ``wd`` step.
    ``keys`` like ``p.level,``; ``on_keys`` like ``AND nb.level = p.level``."""
    group_keys = keys
    return f"""
contrib AS (
  SELECT {group_keys} p.u, p.i, sum(nb.sim * d.dev) AS num, sum(abs(nb.sim)) AS denom,
         count(*) AS n_raters
  FROM (SELECT DISTINCT * EXCLUDE (r) FROM {pairs}) p JOIN {nb} nb ON p.u = nb.u {on_keys}
  JOIN devs d ON d.u = nb.v AND d.i = p.i
  GROUP BY {group_keys} p.u, p.i),
wd AS (
  SELECT {keys} p.u, p.i, p.r, s.avg_rating, c.num, c.denom, c.n_raters,
         coalesce(c.num / nullif(c.denom, 0), 0) AS wdev
  FROM {pairs} p LEFT JOIN user_stats s ON p.u = s.u
  LEFT JOIN contrib c ON p.u = c.u AND p.i = c.i {on_keys.replace('nb.', 'c.')}),
pred AS (
  SELECT wd.*, CASE WHEN avg_rating IS NULL THEN g.global_avg
                    WHEN wdev = 0 THEN avg_rating
                    ELSE avg_rating + wdev * {scale_sql('avg_rating + wdev', 'avg_rating')} END
         AS prediction
  FROM wd CROSS JOIN gstats g)"""


def part_order_sql(partitions: int) -> str:
    """All parts of every user in order: ``(start + j step) mod q`` for each j,
    q the smallest prime >= partitions."""
    q = next(n for n in range(max(partitions, 2), 10 ** 9) if all(n % d for d in range(2, n)))
    number = "CAST('0x' || substr(md5('1337:' || CAST(u AS VARCHAR)), {at}, 15) AS BIGINT)"
    return f"""
part_keys AS (
  SELECT u, {number.format(at=1)} % {q} AS start, {number.format(at=17)} % {q - 1} + 1 AS step FROM user_stats),
ranked_parts AS (
  SELECT u, part, row_number() OVER (PARTITION BY u ORDER BY j) AS rk FROM (
    SELECT u, j, (start + j * step) % {q} AS part FROM part_keys CROSS JOIN range({q}) x(j)) y
  WHERE part < {partitions})""".strip()


def hashed_order_sql(partitions: int) -> str:
    """All parts of every user in the order of ``md5('1337:<u>:<part>')``."""
    return f"""
parts AS (SELECT CAST(range AS BIGINT) AS part FROM range({partitions})),
ranked_parts AS (
  SELECT s.u, pt.part, row_number() OVER (
      PARTITION BY s.u
      ORDER BY md5(concat('1337:', CAST(s.u AS VARCHAR), ':', CAST(pt.part AS VARCHAR))), pt.part) AS rk
  FROM user_stats s CROSS JOIN parts pt)""".strip()


def approx_sql(partitions: int, levels: tuple[int, ...], k: int, order: Callable[[int], str] = part_order_sql) -> str:
    """Approximate neighbours per level: ``assign``, ``cand``, ``pp_top``,
    ``approx_nb(level, u, v, sim, rank)``."""
    lv = ", ".join(f"({min(x, partitions)})" for x in sorted(set(levels)))
    return f"""
levels AS (SELECT CAST(level AS BIGINT) AS level FROM (VALUES {lv}) t(level)),
{order(partitions)},
assign AS (
  SELECT l.level, r.u, r.part FROM ranked_parts r JOIN levels l ON r.rk <= l.level),
cand AS (
  SELECT a.level, a.u, b.u AS v, list_sort(list(a.part)) AS common
  FROM assign a JOIN assign b ON a.level = b.level AND a.part = b.part AND a.u < b.u
  GROUP BY a.level, a.u, b.u),
bhalf AS (
  SELECT c.level, h.u, h.v, h.sim, c.common FROM half h JOIN cand c ON h.u = c.u AND h.v = c.v),
pp AS (
  SELECT level, unnest(common) AS part, u, v, sim FROM (
    SELECT level, u, v, sim, common FROM bhalf
    UNION ALL SELECT level, v AS u, u AS v, sim, common FROM bhalf) x),
{slot_topk_sql('pp_top', 'pp', 'level, part,', k).strip()},
approx_nb AS (
  SELECT level, u, v, max(sim) AS sim, CAST(min(dr) AS BIGINT) AS rank FROM (
    SELECT level, u, v, sim,
           dense_rank() OVER (PARTITION BY level, u ORDER BY sim DESC, v) AS dr
    FROM pp_top) x
  WHERE dr <= {k} GROUP BY level, u, v)"""


def with_(*parts: str) -> str:
    return "WITH " + ",".join(x.strip("\n") for x in parts) + "\n"


BASE = (RATINGS, STATS, DEVS)
EXACT = (RATINGS, STATS, DEVS, SIMS, slot_topk_sql("neighbors", "sims", "", p.K))


def lines_sql(sep: str) -> str:
    u, i, r = "CAST(u + 1 AS VARCHAR)", "CAST(i + 1 AS VARCHAR)", "CAST(r AS VARCHAR)"
    s = f" || '{sep}' || "
    return f"""
lines AS (
  SELECT CASE (u * 13 + i * 7) % 97
    WHEN 0 THEN {u}{s}{i}
    WHEN 1 THEN {u} || '.5'{s}{i}{s}{r}
    WHEN 2 THEN '99999999999' || {u}{s}{i}{s}{r}
    WHEN 3 THEN {u}{s}'x' || {i}{s}{r}
    WHEN 4 THEN {u}{s}{i}{s}'five'
    WHEN 5 THEN {u}{s}{i}{s}CAST(r + 5 AS VARCHAR)
    WHEN 6 THEN ''
    ELSE {u}{s}{i}{s}{r}{s}'0' END AS value FROM ratings),
fields AS (
  SELECT value, len(f) AS nf, trim(f[1]) AS f0, trim(f[2]) AS f1, trim(f[3]) AS f2
  FROM (SELECT value, string_split(value, '{sep}') AS f FROM lines) x),
typed AS (
  SELECT value, nf,
    CASE WHEN regexp_full_match(f0, '[+-]?[0-9]+') THEN try_cast(f0 AS INTEGER) END AS u,
    CASE WHEN regexp_full_match(f1, '[+-]?[0-9]+') THEN try_cast(f1 AS INTEGER) END AS i,
    try_cast(f2 AS DOUBLE) AS r
  FROM fields),
checked AS (
  SELECT value, u, i, r,
    CASE WHEN nf < 3 THEN 'short' WHEN u IS NULL THEN 'user' WHEN i IS NULL THEN 'item'
         WHEN r IS NULL THEN 'rating' WHEN r < {LO} OR r > {HI} THEN 'range' END AS reason
  FROM typed)"""


def _parse(sep: str) -> str:
    return with_(RATINGS, lines_sql(sep)) + (
        "SELECT CAST(u AS BIGINT) - 1 AS u, CAST(i AS BIGINT) - 1 AS i, r "
        "FROM checked WHERE reason IS NULL")


def _mae(pred_from: str) -> str:
    return (f"SELECT round(avg(abs(r - prediction)), 6) AS mae, CAST(count(*) AS BIGINT) AS n_test "
            f"FROM {pred_from}")


APPROX = approx_sql(p.PARTITIONS, (p.REPLICATION,), p.K)
SWEEP = approx_sql(p.PARTITIONS, p.LEVELS, p.K)
APPROX_HASHED = approx_sql(p.PARTITIONS, (p.REPLICATION,), p.K, hashed_order_sql)
SWEEP_HASHED = approx_sql(p.PARTITIONS, p.LEVELS, p.K, hashed_order_sql)


def _assign_single() -> str:
    return f"""
{part_order_sql(p.PARTITIONS)},
assign AS (SELECT u, part, CAST(rk AS BIGINT) AS rank FROM ranked_parts WHERE rk <= {p.REPLICATION})"""


def _rate(gb: float, cpu: float) -> str:
    """The exact decimal price of a second."""
    exact = Decimal(str(gb)) * Decimal(str(p.COST_PER_GB_SECOND)) + Decimal(str(cpu)) * Decimal(str(p.COST_PER_CPU_SECOND))
    return f"{exact:.16f}"


EVENT_RATES = ", ".join(f"('{t}', '{_rate(gb, cpu)}')" for t, gb, cpu in p.EVENT_RESOURCES)

RENT = """
rent AS (
  SELECT l_partkey,
         CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT) * CAST(round((1 - l_discount) * 100) AS BIGINT))
              AS DOUBLE) / CAST(count(DISTINCT l_shipdate) AS DOUBLE) / CAST(10000 AS DOUBLE) AS daily_rent
  FROM lineitem GROUP BY l_partkey)"""


def _positive_zero(sql: str) -> str:
    """Wrap every ``round(...)`` as ``(round(...) + 0.0)``: DuckDB's round
    keeps the sign of a value that rounds to zero."""
    out, i = [], 0
    while True:
        j = sql.find("round(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        if j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_"):
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k = 0, j + 5
        while True:
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        inner = _positive_zero(sql[j + 6:k])
        out.append(sql[i:j] + "(round(" + inner + ") + 0.0)")
        i = k + 1


def oracle_queries() -> dict[str, str]:
    return {name: _positive_zero(sql) for name, sql in _oracle_queries().items()}


def _oracle_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["ratings_parse"] = _parse("\t")
    q["ratings_parse_sep"] = _parse("::")
    q["ratings_rejects"] = with_(RATINGS, lines_sql("\t")) + (
        "SELECT value AS line, reason FROM checked WHERE reason IS NOT NULL")
    q["ratings_dedup"] = with_(RATINGS) + (
        "SELECT u, i, round(sum(CAST(1 + floor((q - 1) / 10) AS DOUBLE)) / count(*), 6) AS r, "
        "CAST(count(*) AS BIGINT) AS n FROM ratings_raw GROUP BY u, i")
    q["train_test_split"] = with_(RATINGS) + (
        "SELECT u, i, r, CASE WHEN (u * 31 + i * 17) % 5 = 0 THEN 'test' ELSE 'train' END AS split "
        "FROM ratings")
    q["dataset_shape"] = with_(RATINGS) + (
        "SELECT CAST(count(DISTINCT u) AS BIGINT) AS n_users, CAST(count(DISTINCT i) AS BIGINT) AS n_items, "
        "CAST(count(*) AS BIGINT) AS n_ratings FROM train")
    q["sum_by_user"] = with_(RATINGS) + "SELECT u, sum(r) AS total FROM train GROUP BY u"
    q["sum_by_item"] = with_(RATINGS) + "SELECT i, sum(r) AS total FROM train GROUP BY i"
    q["global_average"] = with_(RATINGS) + (
        "SELECT round(sum(r) / count(*), 6) AS global_avg, CAST(count(*) AS BIGINT) AS n_ratings, "
        "CAST(count(DISTINCT u) AS BIGINT) AS n_users FROM train")
    q["user_averages"] = with_(RATINGS, STATS) + (
        "SELECT u, round(avg_rating, 6) AS avg_rating, CAST(n AS BIGINT) AS n FROM user_stats")
    q["user_norms"] = with_(*BASE) + "SELECT u, round(norm, 6) AS norm FROM norms"
    q["scale_values"] = with_(RATINGS, STATS) + (
        f"SELECT t.u, t.i, t.r, round(s.avg_rating, 6) AS avg_rating, "
        f"round({scale_sql('t.r', 's.avg_rating')}, 6) AS scale "
        f"FROM train t JOIN user_stats s ON t.u = s.u")
    q["normalized_deviations"] = with_(*BASE) + "SELECT u, i, round(dev, 6) AS dev FROM devs"
    q["unit_ratings"] = with_(*BASE) + "SELECT u, i, round(w, 6) AS w FROM unit"
    q["item_rating_counts"] = with_(RATINGS) + (
        "SELECT i, CAST(count(*) AS BIGINT) AS n_raters FROM train GROUP BY i")
    q["summary_stats"] = with_(RATINGS) + (
        "SELECT u, CAST(count(*) AS BIGINT) AS n, round(coalesce(avg(r), 0), 6) AS mean, "
        "round(coalesce(stddev_pop(r), 0), 6) AS std FROM train GROUP BY u")
    q["sparse_matmul"] = with_(RATINGS) + (
        "SELECT t.u AS row, p_brand AS col, sum(t.r * CAST(round(p_retailprice * 100) AS DOUBLE)) AS val "
        "FROM train t JOIN part ON t.i = p_partkey GROUP BY t.u, p_brand "
        "HAVING sum(t.r * CAST(round(p_retailprice * 100) AS DOUBLE)) <> 0")
    q["matmul_hot_keys"] = with_(RATINGS) + (
        "SELECT t.u AS row, CAST(b.p_size AS BIGINT) AS col, sum(t.r) AS val "
        "FROM train t JOIN part a ON t.i = a.p_partkey JOIN part b ON a.p_brand = b.p_brand GROUP BY t.u, b.p_size")
    q["similarity_all_pairs"] = with_(*BASE, SIMS) + "SELECT u, v, sim FROM sims"
    q["similarity_for_users"] = with_(*BASE) + (
        "SELECT u, v, sim FROM (SELECT a.u AS u, b.u AS v, " + snap_sql("sum(a.w * b.w)") + " AS sim "
        "FROM unit a JOIN unit b ON a.i = b.i AND a.u <> b.u "
        f"WHERE a.u IN (SELECT c_custkey FROM customer WHERE c_nationkey = {p.NATION}) GROUP BY a.u, b.u) x WHERE sim <> 0")
    q["similarity_lookup"] = with_(*BASE, SIMS) + (
        "SELECT x.u, x.v, coalesce(s.sim, 0) AS sim FROM "
        "(SELECT DISTINCT min(u) AS u, max(u) AS v FROM test GROUP BY i HAVING min(u) <> max(u)) x "
        "LEFT JOIN sims s ON x.u = s.u AND x.v = s.v")
    q["topk_neighbors"] = with_(*EXACT) + "SELECT u, v, sim, rank FROM neighbors"
    q["topk_neighbors_bounded"] = q["topk_neighbors"]
    q["topk_neighbors_kept"] = q["topk_neighbors"]
    q["similarity_point_lookup"] = with_(*EXACT) + (
        "SELECT x.u, x.v, coalesce(s.sim, 0) AS sim FROM (SELECT min(u) AS u, max(u) AS v FROM test GROUP BY i "
        "HAVING min(u) <> max(u) ORDER BY 1, 2 LIMIT 1) x LEFT JOIN sims s ON x.u = s.u AND x.v = s.v")
    q["neighbor_counts"] = with_(*EXACT) + (
        "SELECT u, CAST(count(*) AS BIGINT) AS n_neighbors FROM neighbors WHERE sim <> 0 GROUP BY u")
    pred_exact = predict_sql("neighbors", "test")
    q["weighted_deviation"] = with_(*EXACT, pred_exact) + "SELECT u, i, round(wdev, 6) AS wdev FROM wd"
    q["neighbor_weight_sums"] = with_(*EXACT, pred_exact) + (
        "SELECT u, i, round(coalesce(denom, 0), 6) AS denom, CAST(coalesce(n_raters, 0) AS BIGINT) AS n_raters "
        "FROM wd")
    q["predict_pairs"] = with_(*EXACT, pred_exact) + (
        "SELECT u, i, r, round(prediction, 6) AS prediction FROM pred")
    q["predict_pairs_kept"] = q["predict_pairs"]
    q["mae_exact"] = with_(*EXACT, pred_exact) + _mae("pred")
    lines = """lines AS (
  SELECT u, i, CAST(1 + floor((q - 1) / 10) AS DOUBLE) AS r FROM ratings_raw WHERE (u * 31 + i * 17) % 5 = 0)"""
    q["mae_lines"] = with_(*EXACT, lines, predict_sql("neighbors", "lines")) + _mae("pred")
    q["mae_user_avg"] = with_(RATINGS, STATS) + _mae(
        "(SELECT t.r, coalesce(s.avg_rating, g.global_avg) AS prediction FROM test t "
        "LEFT JOIN user_stats s ON t.u = s.u CROSS JOIN gstats g) x")
    q["assign_partitions"] = with_(RATINGS, STATS, _assign_single()) + "SELECT u, part, rank FROM assign"
    q["partition_sizes"] = with_(RATINGS, STATS, _assign_single()) + (
        "SELECT part, CAST(count(*) AS BIGINT) AS n_users FROM assign GROUP BY part")
    q["user_partitions"] = with_(RATINGS, STATS, _assign_single()) + (
        "SELECT u, array_to_string(list_sort(list(part)), ',') AS parts FROM assign GROUP BY u")
    q["partition_unit_ratings"] = with_(*BASE, _assign_single()) + (
        "SELECT a.part, n.u, n.i, round(n.w, 6) AS w FROM unit n JOIN assign a ON n.u = a.u")
    approx = (*BASE, SIMS, APPROX)
    hashed = (*BASE, SIMS, APPROX_HASHED)
    q["similarity_blocked"] = with_(*hashed) + (
        "SELECT u, v, sim FROM bhalf UNION ALL SELECT v AS u, u AS v, sim FROM bhalf")
    q["topk_per_partition"] = with_(*approx) + "SELECT part, u, v, sim, rank FROM pp_top"
    q["merge_topk"] = with_(*approx) + "SELECT u, v, sim, rank FROM approx_nb"
    q["topk_approx"] = with_(*hashed) + "SELECT u, v, sim, rank FROM approx_nb"
    pred_approx = predict_sql("approx_nb", "test")
    q["mae_approx"] = with_(*approx, pred_approx) + _mae("pred")
    sweep_pairs = "sweep_pairs AS (SELECT l.level, t.u, t.i, t.r FROM test t CROSS JOIN levels l)"
    pred_sweep = predict_sql("approx_nb", "sweep_pairs", "p.level,", "AND nb.level = p.level")
    q["replication_sweep"] = with_(*BASE, SIMS, SWEEP, sweep_pairs, pred_sweep) + (
        "SELECT level, round(avg(abs(r - prediction)), 6) AS mae, CAST(count(*) AS BIGINT) AS n_test "
        "FROM pred GROUP BY level")
    q["candidate_ratio"] = with_(*BASE, SIMS, SWEEP_HASHED) + """,
cp AS (
  SELECT level, CAST(count(*) AS BIGINT) AS candidate_pairs FROM (
    SELECT DISTINCT a.level, a.u, b.u AS v FROM assign a
    JOIN assign b ON a.level = b.level AND a.part = b.part AND a.u <> b.u) x GROUP BY level),
bp AS (
  SELECT level, CAST(sum(c * (c - 1)) AS BIGINT) AS block_pairs FROM (
    SELECT level, part, count(*) AS c FROM assign GROUP BY level, part) y GROUP BY level)
SELECT cp.level, cp.candidate_pairs, CAST(g.n_users * (g.n_users - 1) AS BIGINT) AS all_pairs,
       round(cp.candidate_pairs / (g.n_users * (g.n_users - 1)), 6) AS candidate_ratio,
       bp.block_pairs, round(bp.block_pairs / (g.n_users * (g.n_users - 1)), 6) AS block_ratio
FROM cp JOIN bp ON cp.level = bp.level CROSS JOIN gstats g"""
    q["candidate_ratio"] = q["candidate_ratio"].replace("\n,\ncp AS", ",\ncp AS")
    score_all = """,
sa AS (
  SELECT nb.u, d.i, sum(nb.sim * d.dev) AS num, sum(abs(nb.sim)) AS denom
  FROM neighbors nb JOIN devs d ON d.u = nb.v GROUP BY nb.u, d.i),
sa_pred AS (
  SELECT sa.u, sa.i, CASE WHEN coalesce(num / nullif(denom, 0), 0) = 0 THEN s.avg_rating
    ELSE s.avg_rating + (num / denom) * """ + scale_sql("s.avg_rating + num / denom", "s.avg_rating") + """ END
    AS prediction
  FROM sa JOIN user_stats s ON sa.u = s.u)"""
    q["score_all_items"] = with_(*EXACT, score_all.lstrip(",\n")) + (
        "SELECT u, i, round(prediction, 6) AS prediction FROM sa_pred")
    q["recommend_top_n"] = with_(*EXACT, score_all.lstrip(",\n")) + f"""
SELECT u, i, round(prediction, 6) AS prediction, CAST(rn AS BIGINT) AS rank FROM (
  SELECT u, i, prediction, row_number() OVER (PARTITION BY u ORDER BY {snap_sql('prediction')} DESC, i) AS rn
  FROM sa_pred x WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.u = x.u AND t.i = x.i)) y
WHERE rn <= {p.TOP_N}"""
    q["recommend_top_n_bounded"] = q["recommend_top_n"]
    q["report_json"] = with_(*EXACT, pred_exact) + f""",
best AS (SELECT u, v, sim FROM neighbors WHERE rank = 1 ORDER BY sim DESC, u LIMIT 1),
shape AS (
  SELECT count(DISTINCT u) AS n_users, count(DISTINCT i) AS n_items, count(*) AS n_ratings FROM train),
ex AS (SELECT round(avg(abs(r - prediction)), 6) AS mae, count(*) AS n_test FROM pred),
ua AS (
  SELECT round(avg(abs(t.r - coalesce(s.avg_rating, g.global_avg))), 6) AS mae
  FROM test t LEFT JOIN user_stats s ON t.u = s.u CROSS JOIN gstats g)
SELECT CAST(to_json({{
  'meta': {{'k': {p.K}, 'n_users': shape.n_users, 'n_items': shape.n_items,
            'n_ratings': shape.n_ratings, 'n_test': ex.n_test}},
  'exact': {{'mae_exact': ex.mae, 'mae_user_avg': ua.mae,
             'best_pair': {{'u': best.u, 'v': best.v, 'sim': best.sim}}}}}}) AS VARCHAR) AS report
FROM shape CROSS JOIN ex CROSS JOIN ua CROSS JOIN best"""
    q["report_json"] = q["report_json"].replace("\n,\nbest AS", ",\nbest AS")
    q["breakeven_days"] = with_(RENT) + f"""
SELECT p_partkey, round(p_retailprice * {p.PRICE_MULTIPLIER}, 6) AS price, round(daily_rent, 6) AS daily_rent,
       CAST(ceil((p_retailprice * {p.PRICE_MULTIPLIER}) / nullif(daily_rent, 0)) AS BIGINT) AS days
FROM part LEFT JOIN rent ON p_partkey = l_partkey"""
    q["breakeven_net_days"] = with_(RENT) + f"""
SELECT p_partkey, round(daily_rent - {p.OWN_DAILY_COST}, 6) AS daily_margin,
       CAST(CASE WHEN daily_rent > {p.OWN_DAILY_COST}
            THEN ceil((p_retailprice * {p.PRICE_MULTIPLIER}) / (daily_rent - {p.OWN_DAILY_COST})) END AS BIGINT) AS days
FROM part LEFT JOIN rent ON p_partkey = l_partkey"""
    q["usage_daily_cost"] = f"""
WITH rates AS (
  SELECT event_type, CAST(rate AS DECIMAL(18,16)) AS rate
  FROM (VALUES {EVENT_RATES}) t(event_type, rate))
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, user_id, CAST(count(*) AS BIGINT) AS n_events,
       CAST(count(*) FILTER (WHERE rate IS NULL) AS BIGINT) AS n_unpriced,
       CAST(sum(CAST(value AS DECIMAL(18,2))) * 100 AS DOUBLE) / 100 AS usage_seconds,
       CAST(sum(CAST(value AS DECIMAL(18,2)) * rate) * 100000000000000 AS DOUBLE) / 1e14 AS daily_cost
FROM events e LEFT JOIN rates r ON e.event_type = r.event_type
GROUP BY CAST(ts AS DATE), user_id"""
    q["budget_units_ratio"] = f"""
WITH shipped AS (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem),
price AS (
  SELECT l_suppkey, CAST(sum(CAST(round(p_retailprice * 100) AS BIGINT)) AS DOUBLE)
         / CAST(count(*) AS DOUBLE) / CAST(100 AS DOUBLE) AS unit_price
  FROM shipped JOIN part ON l_partkey = p_partkey GROUP BY l_suppkey),
units AS (
  SELECT s_suppkey, greatest(s_acctbal, 0) AS budget, unit_price,
         CAST(floor(greatest(s_acctbal, 0) / unit_price) AS BIGINT) AS units
  FROM supplier LEFT JOIN price ON s_suppkey = l_suppkey)
SELECT s_suppkey, round(budget, 6) AS budget, round(unit_price, 6) AS unit_price, units,
       round(units * {p.UNIT_RAM_GB} / {p.REFERENCE_RAM_GB}, 6) AS ram_ratio,
       round(units / {float(p.REFERENCE_CORES * p.UNITS_PER_CORE)}, 6) AS compute_ratio
FROM units"""
    return q
