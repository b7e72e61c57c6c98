"""SQL twins of the trained models: the isolation forest grown and walked level by level."""

from __future__ import annotations

from .sqlbase import np_round_sql

_M = 4294967296


def _mix32_sql(x: str) -> str:
    """The 32-bit hash: xor-shifts and products modulo 2^32, a lambda for each step."""
    def times(m: int) -> str:
        return f"((v % 65536) * {m} + (((v // 65536) * {m}) % 65536) * 65536) % {_M}"

    out = f"[CAST({x} AS BIGINT) % {_M}]"
    for body in ("xor(v, v // 65536)", times(2246822507), "xor(v, v // 8192)", times(3266489909), "xor(v, v // 65536)"):
        out = f"list_transform({out}, lambda v: {body})"
    return f"{out}[1]"


def _tree_hash_sql(seed: int, use: int) -> str:
    inner = _mix32_sql(str(seed * 7919 + use))
    return _mix32_sql(f"{_mix32_sql(f'{inner} + tree')} + node")


def _path_sql(n: str) -> str:
    return (f"CASE WHEN {n} <= 1 THEN 0.0::DOUBLE WHEN {n} = 2 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE * "
            f"(ln(CAST({n} AS DOUBLE) - 1.0::DOUBLE) + 0.5772156649015329::DOUBLE) - "
            f"2.0::DOUBLE * (CAST({n} AS DOUBLE) - 1.0::DOUBLE) / CAST({n} AS DOUBLE) END")


def isolation_ctes(table: str, key: str, features: list[str], keep: str, trees: int = 100, size: int = 256,
                   share: float = 0.95, seed: int = 42, levels: int = 12) -> str:
    """CTEs ending in ``iso`` (key, kept columns, anomaly_score, is_anomaly) for ``table``.

    ``levels`` is enough for samples of up to 2^levels rows of a tree.
    """
    k = len(features)
    of = lambda use: _mix32_sql(f"({key} % {_M}) + {_mix32_sql(str(seed * 7919 + use))}")
    lists = lambda f: ", ".join(f"{f}(x[{i}])" for i in range(1, k + 1))
    grow = []
    for d in range(levels + 1):
        grow += [
            f"s{d} AS (SELECT tree, node, count(*) AS size, [{lists('min')}] AS lo, [{lists('max')}] AS hi FROM l{d} GROUP BY tree, node)",
            f"c{d} AS (SELECT s.*, CASE WHEN {d} >= lim OR size <= 1 THEN [] ELSE "
            f"list_filter(range(1, {k + 1}), lambda f: hi[f] > lo[f]) END AS c FROM s{d} s JOIN lim USING (tree))",
            f"f{d} AS (SELECT *, CASE WHEN len(c) = 0 THEN 0 ELSE c[1 + {_tree_hash_sql(seed, 2)} % len(c)] END AS feature FROM c{d})",
            f"p{d} AS (SELECT *, CASE WHEN feature = 0 THEN 0.0::DOUBLE ELSE lo[feature] + (hi[feature] - lo[feature]) * "
            f"((CAST({_tree_hash_sql(seed, 3)} AS DOUBLE) + 0.5::DOUBLE) / {float(_M)}::DOUBLE) END AS point FROM f{d})",
            f"n{d} AS (SELECT tree, node, size, {d} AS depth, feature, "
            f"CASE WHEN feature = 0 OR point > lo[feature] THEN point ELSE hi[feature] END AS split FROM p{d})",
            f"l{d + 1} AS (SELECT l.tree, 2 * l.node + CASE WHEN x[feature] < split THEN 0 ELSE 1 END AS node, x "
            f"FROM l{d} l JOIN n{d} n ON l.tree = n.tree AND l.node = n.node WHERE feature > 0)"]
    walk = [f"w{d + 1} AS (SELECT w.{key}, w.x, w.tree, CASE WHEN n.feature = 0 THEN w.node "
            f"ELSE 2 * w.node + CASE WHEN x[n.feature] < n.split THEN 0 ELSE 1 END END AS node "
            f"FROM w{d} w JOIN nodes n ON n.tree = w.tree AND n.node = w.node)" for d in range(levels)]
    return f"""
iso_x AS (SELECT {key}, [{', '.join(f'coalesce(CAST({f} AS DOUBLE), 0.0::DOUBLE)' for f in features)}] AS x FROM {table}),
iso_n AS (SELECT greatest(count(*), 1) AS n FROM iso_x),
deal AS (
  SELECT {key}, x, {of(1)} % {trees} AS first,
         CAST(floor({float(trees)}::DOUBLE * least(1.0::DOUBLE, {float(size)}::DOUBLE / n) + {of(0)} / {float(_M)}::DOUBLE) AS BIGINT) AS k
  FROM iso_x, iso_n),
l0 AS (SELECT (first + j) % {trees} AS tree, CAST(1 AS BIGINT) AS node, x FROM deal, unnest(range(k)) AS r(j)),
lim AS (SELECT tree, CAST(ceil(log2(greatest(count(*), 2)) - 1e-9) AS INTEGER) AS lim FROM l0 GROUP BY tree),
{', '.join(grow)},
nodes AS ({' UNION ALL '.join(f'SELECT * FROM n{d}' for d in range(levels + 1))}),
w0 AS (SELECT {key}, x, tree, CAST(1 AS BIGINT) AS node FROM iso_x, (SELECT DISTINCT tree FROM l0)),
{', '.join(walk)},
psi AS (SELECT count(*) AS trees, sum(size) / count(*) AS psi FROM nodes WHERE node = 1),
paths AS (
  SELECT w.{key}, CAST(sum(CAST(round((depth + {_path_sql('size')}) * 1e9::DOUBLE) AS BIGINT)) AS DOUBLE) AS total
  FROM w{levels} w JOIN nodes n ON n.tree = w.tree AND n.node = w.node GROUP BY w.{key}),
raw AS (
  SELECT {key}, power(2.0::DOUBLE, -(total / 1e9::DOUBLE / trees) / CASE WHEN psi <= 1 THEN 1.0::DOUBLE ELSE {_path_sql('psi')} END) AS s
  FROM paths, psi),
ranked AS (SELECT s, row_number() OVER (ORDER BY s) - 1 AS r, (count(*) OVER () - 1) * {share}::DOUBLE AS h FROM raw),
edge AS (
  SELECT max(CASE WHEN r = floor(h) THEN s END) AS lo, max(CASE WHEN r = floor(h) + 1 THEN s END) AS hi, max(h - floor(h)) AS part FROM ranked),
iso AS (
  SELECT {key}, {keep}raw.s AS score, CASE WHEN raw.s > lo + (coalesce(hi, lo) - lo) * part THEN 1 ELSE 0 END AS is_anomaly,
         {np_round_sql('raw.s', 6)} AS anomaly_score
  FROM raw JOIN {table} USING ({key}), edge),
"""


def kmeans_ctes(table: str, key: str, value: str, features: list[str], ks: range, restarts: int = 10, seed: int = 42,
                max_iter: int = 300) -> tuple[str, str]:
    """CTEs (the first recursive) and the body that give every row's segment for ``table``.

    K-means++ by hashed draws, Lloyd's iterations of all models in one recursion, the
    silhouette from cluster moments.
    """
    d, top = len(features), max(ks)
    units = "1073741824"
    dist = lambda c, x: "(" + " + ".join(f"({c}[{j}] - {x}[{j}]) * ({c}[{j}] - {x}[{j}])" for j in range(1, d + 1)) + ")"
    dot = lambda a, b: "(" + " + ".join(f"{a}[{j}] * {b}[{j}]" for j in range(1, d + 1)) + ")"
    whole = lambda e: f"CAST(sum(CAST(round({e} * {units}.0::DOUBLE) AS HUGEINT)) AS DOUBLE) / {units}.0::DOUBLE"
    sums = "[" + ", ".join(whole(f"x[{j}]") for j in range(1, d + 1)) + "]"
    stats = ", ".join(f"avg(CAST({f} AS DOUBLE)) AS m{j}, stddev_pop(CAST({f} AS DOUBLE)) AS d{j}" for j, f in enumerate(features))
    z = ", ".join(f"(CAST({f} AS DOUBLE) - m{j}) / CASE WHEN coalesce(d{j}, 0) = 0 THEN 1.0::DOUBLE ELSE d{j} END" for j, f in enumerate(features))
    mean = "[" + ", ".join(f"s[{j}] / n" for j in range(1, d + 1)) + "]"
    steps = []
    for s in range(top):
        salt = _mix32_sql(f"{_mix32_sql(f'{_mix32_sql(str(seed * 7919 + s))} + k')} + r")
        apart = f"list_min(list_transform(c, lambda v: {dist('v', 'x')}))" if s else "1.0::DOUBLE"
        steps.append(
            f"q{s} AS (SELECT k, r, c, {salt} AS salt FROM s{s} WHERE k > {s} AND len(c) = {s}), "
            f"a{s} AS (SELECT k, r, c, x, n, salt, {apart} AS d2 FROM q{s}, kp), "
            f"s{s + 1} AS (SELECT k, r, list_append(any_value(c), arg_max(x, ln((CAST({_mix32_sql('n + salt')} AS DOUBLE) + 0.5::DOUBLE) "
            f"/ {float(_M)}::DOUBLE) / d2)) AS c FROM a{s} WHERE d2 > 1e-9::DOUBLE GROUP BY k, r UNION ALL SELECT k, r, c FROM s{s} WHERE k <= {s})")
    ctes = f"""
kstat AS (SELECT {stats} FROM {table}),
kp AS (SELECT {key}, CAST({value} AS DOUBLE) AS value, {key} % {_M} AS n, [{z}] AS x FROM {table}, kstat),
s0 AS (SELECT CAST(k AS INTEGER) AS k, CAST(r AS INTEGER) AS r, CAST([] AS DOUBLE[][]) AS c FROM range({min(ks)}, {top + 1}) a(k), range({restarts}) b(r)),
{', '.join(steps)},
kl(it, k, r, c, cost, moving) AS (
  SELECT 0, k, r, c, CAST('inf' AS DOUBLE), true FROM s{top} WHERE len(c) = k
  UNION ALL
  SELECT it + 1, k, r, nc, cost, list_max(list_transform(range(1, k + 1), lambda j: {dist('nc[j]', 'c[j]')})) > 1e-8::DOUBLE FROM (
   SELECT it, k, r, c, cost, list_transform(range(1, k + 1), lambda j: coalesce(m[j], c[j])) AS nc FROM (
    SELECT it, k, r, c, sum(q - 2.0::DOUBLE * {dot('c[lab]', 's')} + n * {dot('c[lab]', 'c[lab]')}) AS cost,
           map_from_entries(list((lab, {mean}))) AS m
    FROM (
      SELECT it, k, r, c, lab, CAST(count(*) AS DOUBLE) AS n, {sums} AS s, {whole(dot('x', 'x'))} AS q FROM (
        SELECT it, k, r, c, x, list_position(far, list_min(far)) AS lab FROM (
          SELECT kl.it, kl.k, kl.r, kl.c, kp.x, list_transform(kl.c, lambda v: {dist('v', 'kp.x')}) AS far
          FROM kl, kp WHERE kl.moving AND kl.it < {max_iter}) f) l
      GROUP BY it, k, r, c, lab) g
    GROUP BY it, k, r, c) h) i),
klast AS (SELECT * FROM kl WHERE it > 0 QUALIFY row_number() OVER (PARTITION BY k, r ORDER BY it DESC) = 1),
kbest AS (SELECT k, c FROM klast QUALIFY row_number() OVER (PARTITION BY k ORDER BY round(cost, 6), r) = 1),
klab AS (
  SELECT k, {key}, value, x, list_position(far, list_min(far)) AS lab FROM (
    SELECT k, {key}, value, x, list_transform(c, lambda v: {dist('v', 'x')}) AS far FROM kbest, kp) f),
kmom AS (SELECT k, lab, CAST(count(*) AS DOUBLE) AS n, {sums} AS s, {whole(dot('x', 'x'))} AS q FROM klab GROUP BY k, lab),
kpair AS (
  SELECT l.k, l.{key}, l.lab AS own, m.lab, m.n, {dot('l.x', 'l.x')} + m.q / m.n - 2.0::DOUBLE * {dot('l.x', 'm.s')} / m.n AS mean
  FROM klab l JOIN kmom m ON l.k = m.k),
kone AS (
  SELECT k, {key}, max(CASE WHEN lab = own THEN n END) AS n, max(CASE WHEN lab = own THEN mean * n / greatest(n - 1, 1) END) AS a,
         min(CASE WHEN lab <> own THEN mean END) AS b FROM kpair GROUP BY k, {key}),
ksil AS (
  SELECT k, round(avg(CASE WHEN n > 1 AND b IS NOT NULL AND greatest(a, b) > 0 THEN (b - a) / greatest(a, b) ELSE 0.0::DOUBLE END), 6) AS s
  FROM kone GROUP BY k),
kpick AS (SELECT k, s FROM ksil ORDER BY s DESC, k LIMIT 1),
kout AS (SELECT l.{key}, l.value, l.lab - 1 AS cluster, p.k, p.s FROM klab l JOIN kpick p ON l.k = p.k),
krank AS (SELECT cluster, row_number() OVER (ORDER BY avg(value) DESC, cluster) - 1 AS cluster_rank FROM kout GROUP BY cluster),
"""
    body = f"""SELECT {key}, CAST(cluster AS INTEGER) AS cluster, CAST(cluster_rank AS INTEGER) AS cluster_rank,
       coalesce(['Champions', 'Loyal Customers', 'At Risk', 'Hibernating', 'Lost'][cluster_rank + 1],
                'Segment_' || CAST(cluster_rank AS VARCHAR)) AS segment_name,
       CAST(k AS INTEGER) AS k, s AS silhouette FROM kout JOIN krank USING (cluster)"""
    return ctes, body
