"""SQL that grows boosted trees, routes rows down them and takes gradient steps, from tables (customer_id, label, features)."""

UNIT = 1 << 30


def _worth(g, h, alpha, lam):
    shrunk = f"greatest(abs(({g}) / {UNIT}) - {alpha}, 0.0::DOUBLE)"
    return f"({shrunk} * {shrunk} / (({h}) / {UNIT} + {lam}))"


def tree_ctes(table, features, rounds, steps, best_first=False, step=0.3, alpha=0.25, lam=0.25, min_weight=0.0, min_rows=1,
              bins=255, mean_start=False):
    """CTEs that end in ``nodes``: ``steps`` levels, or single best splits, per tree. ``table`` is a CTE without nulls."""
    long = " UNION ALL ".join(f"SELECT customer_id, {i} AS feature, CAST({f} AS DOUBLE) AS x FROM {table}" for i, f in enumerate(features))
    names = "[" + ", ".join(f"'{f}'" for f in features) + "]"
    start = "ln(avg(label) / (1 - avg(label)))" if mean_start else "any_value(0.0::DOUBLE)"
    ctes = [
        f"long AS MATERIALIZED ({long})",
        """per_value AS (
  SELECT feature, x, count(*) AS n, sum(count(*)) OVER (PARTITION BY feature ORDER BY x) AS upto, sum(count(*)) OVER (PARTITION BY feature) AS total,
    count(*) OVER (PARTITION BY feature) AS different, max(x) OVER (PARTITION BY feature) AS largest FROM long GROUP BY feature, x)""",
        f"""bin_ends AS MATERIALIZED (
  SELECT feature, x, row_number() OVER (PARTITION BY feature ORDER BY x) AS code FROM per_value
  WHERE x < largest AND (different <= {bins} OR floor(upto * {bins} / total) > floor((upto - n) * {bins} / total)))""",
        """coded AS MATERIALIZED (
  SELECT l.customer_id, l.feature, 1 + count(c.x) AS code FROM long l LEFT JOIN bin_ends c ON c.feature = l.feature AND c.x < l.x GROUP BY ALL)""",
        f"base AS (SELECT {start} AS margin FROM {table})",
        f"margins0 AS (SELECT customer_id, label, margin FROM {table}, base)",
    ]
    for t in range(rounds):
        ctes += [
            f"""slopes{t} AS MATERIALIZED (
  SELECT customer_id, CAST(round((p - label) * {UNIT}) AS BIGINT) AS g, CAST(round(greatest(p * (1 - p), 1e-16) * {UNIT}) AS BIGINT) AS h
  FROM (SELECT customer_id, label, 1 / (1 + exp(-margin)) AS p FROM margins{t}))""",
            f"at{t}_0 AS MATERIALIZED (SELECT customer_id, 0 AS node FROM slopes{t})",
        ]
        for k in range(steps):
            new = f"2 * {k} + 1" if best_first else f"(SELECT 1 + max(node) FROM seen{t}_{k}) + 2 * (row_number() OVER (ORDER BY node) - 1)"
            first = "ORDER BY gain DESC, node LIMIT 1" if best_first else ""
            seen = f"SELECT node FROM seen{t}_{k - 1} UNION SELECT left_node FROM split{t}_{k - 1} UNION SELECT left_node + 1 FROM split{t}_{k - 1}"
            ctes += [
                f"seen{t}_{k} AS MATERIALIZED ({seen if k else 'SELECT 0 AS node'})",
                f"""sums{t}_{k} AS MATERIALIZED (
  SELECT node, sum(g) AS g, sum(h) AS h, count(*) AS n FROM at{t}_{k} JOIN slopes{t} USING (customer_id) GROUP BY node)""",
                f"""cells{t}_{k} AS (
  SELECT node, feature, code, sum(sum(g)) OVER w AS gl, sum(sum(h)) OVER w AS hl, sum(count(*)) OVER w AS nl
  FROM at{t}_{k} JOIN coded USING (customer_id) JOIN slopes{t} USING (customer_id) GROUP BY node, feature, code
  WINDOW w AS (PARTITION BY node, feature ORDER BY code))""",
                f"""gains{t}_{k} AS (
  SELECT node, feature, code, ({_worth('gl', 'hl', alpha, lam)} + {_worth('g - gl', 'h - hl', alpha, lam)}) - {_worth('g', 'h', alpha, lam)} AS gain
  FROM cells{t}_{k} JOIN sums{t}_{k} USING (node)
  WHERE least(nl, n - nl) >= {min_rows} AND least(hl, h - hl) >= {min_weight} * {UNIT})""",
                f"""split{t}_{k} AS MATERIALIZED (
  SELECT node, feature, code, gain, CAST({new} AS INTEGER) AS left_node FROM (
    SELECT *, row_number() OVER (PARTITION BY node ORDER BY gain DESC, feature, code) AS place FROM gains{t}_{k})
  WHERE place = 1 AND gain > 1e-6 {first})""",
                f"""at{t}_{k + 1} AS MATERIALIZED (
  SELECT a.customer_id, CASE WHEN s.node IS NULL THEN a.node WHEN c.code <= s.code THEN s.left_node ELSE s.left_node + 1 END AS node
  FROM at{t}_{k} a LEFT JOIN split{t}_{k} s ON s.node = a.node LEFT JOIN coded c ON c.customer_id = a.customer_id AND c.feature = s.feature)""",
            ]
        splits = " UNION ALL ".join(f"SELECT s.*, u.h, u.n FROM split{t}_{k} s JOIN sums{t}_{k} u USING (node)" for k in range(steps))
        shrunk = f"greatest(abs(g / {UNIT}) - {alpha}, 0.0::DOUBLE)"
        ctes += [
            f"""ends{t} AS MATERIALIZED (
  SELECT node, sum(h) AS h, count(*) AS n, {step} * (-sign(sum(g)) * {shrunk.replace('abs(g /', 'abs(sum(g) /')} / (sum(h) / {UNIT} + {lam})) AS value
  FROM at{t}_{steps} JOIN slopes{t} USING (customer_id) GROUP BY node)""",
            f"""nodes{t} AS MATERIALIZED (
  SELECT {t} AS tree, node, {names}[s.feature + 1] AS feature, c.x AS threshold, left_node, left_node + 1 AS right_node, 0.0::DOUBLE AS value, gain,
    h / {UNIT} AS cover, n FROM ({splits}) s JOIN bin_ends c ON c.feature = s.feature AND c.code = s.code
  UNION ALL SELECT {t}, node, NULL, NULL, NULL, NULL, value, NULL, h / {UNIT}, n FROM ends{t})""",
            f"margins{t + 1} AS (SELECT customer_id, label, margin + value AS margin FROM margins{t} JOIN at{t}_{steps} USING (customer_id) JOIN ends{t} USING (node))",
        ]
    ctes.append("nodes AS (" + " UNION ALL ".join(f"SELECT * FROM nodes{t}" for t in range(rounds)) + ")")
    return ctes


def routed_ctes(table, features):
    """CTEs that end in ``steps_of`` (customer_id, tree, value): the rows of ``table`` down ``nodes``, level by level."""
    long = " UNION ALL ".join(f"SELECT customer_id, '{f}' AS feature, CAST({f} AS DOUBLE) AS x FROM {table}" for f in features)
    return [
        f"values_of AS MATERIALIZED ({long})",
        f"""reach AS (
  SELECT customer_id, tree, 0 AS node FROM {table}, (SELECT DISTINCT tree FROM nodes)
  UNION ALL
  SELECT r.customer_id, r.tree, CASE WHEN v.x <= n.threshold THEN n.left_node ELSE n.right_node END
  FROM reach r JOIN nodes n ON n.tree = r.tree AND n.node = r.node JOIN values_of v ON v.customer_id = r.customer_id AND v.feature = n.feature)""",
        "steps_of AS (SELECT r.customer_id, r.tree, n.value FROM reach r JOIN nodes n ON n.tree = r.tree AND n.node = r.node WHERE n.feature IS NULL)",
    ]


def descent_ctes(table, features, steps, rate=0.1):
    """CTEs weights0 … weights<steps>, each one row (w0, w1 …): intercept first, features standardised."""
    k = len(features)
    stats = ", ".join(f"avg({f}) AS m{i}, CASE WHEN stddev_pop({f}) = 0 THEN 1 ELSE stddev_pop({f}) END AS s{i}" for i, f in enumerate(features, 1))
    scaled = ", ".join(f"({f} - m{i}) / s{i} AS x{i}" for i, f in enumerate(features, 1))
    out = [f"stats AS MATERIALIZED (SELECT {stats} FROM {table})",
           f"scaled AS MATERIALIZED (SELECT label AS y, 1.0::DOUBLE AS x0, {scaled} FROM {table}, stats)",
           "weights0 AS (SELECT " + ", ".join(f"0.0::DOUBLE AS w{i}" for i in range(k + 1)) + ")"]
    z = " + ".join(f"w{i} * x{i}" for i in range(k + 1))
    for t in range(steps):
        out.append(f"weights{t + 1} AS MATERIALIZED (SELECT " + ", ".join(
            f"any_value(w{i}) - {rate} * avg((1 / (1 + exp(-({z}))) - y) * x{i}) AS w{i}" for i in range(k + 1)) + f" FROM scaled, weights{t})")
    return out
