"""Independent SQL (DuckDB dialect) for every registered query.

Each key's SQL is a chain of CTEs over the raw tables. The SQL is written from the
reference's definitions, not from the Spark plans: the two-hop search joins the graph
with "paths" (graph edges plus zero-length self loops), the detailed link data is a
join of pairs with per-type counts instead of map arithmetic, and the Bayes step is a
plain join. Numeric policy matches the Spark side: scaled weights are exact BIGINT counts of
1e-9 units, sums are integer sums, one conversion to DOUBLE before dividing.
"""

from __future__ import annotations

from affinity.params import PARAMS_E, PARAMS_T, PATH_NHOOD, RecParams


def _num(x: float) -> str:
    return repr(float(x))


def _units(x: float) -> str:
    """Exact 1e-9 unit count of a threshold (0.25 -> 250000000)."""
    from decimal import ROUND_HALF_UP, Decimal

    d = Decimal(repr(float(x))) * 1_000_000_000
    return str(int(d.quantize(Decimal(1), rounding=ROUND_HALF_UP)))


def dbl(expr: str) -> str:
    """LONG units -> DOUBLE weight."""
    return f"(CAST({expr} AS DOUBLE) / 1000000000.0::DOUBLE)"


def units(expr: str) -> str:
    """DOUBLE weight -> LONG units, half up at the 9th place."""
    return f"CAST(FLOOR(CAST({expr} AS DOUBLE) * 1000000000.0::DOUBLE + 0.5::DOUBLE) AS BIGINT)"


class SqlBuilder:
    """Accumulates named CTEs and renders ``WITH ... SELECT``."""

    def __init__(self) -> None:
        self.ctes: list[tuple[str, str]] = []
        self.names: set[str] = set()
        #: Compute every step once, whoever reads it.
        self.materialize = False

    def add(self, name: str, body: str) -> str:
        if name not in self.names:
            self.ctes.append((name, body))
            self.names.add(name)
        return name

    def render(self, select: str) -> str:
        if not self.ctes:
            return select
        once = "MATERIALIZED " if self.materialize else ""
        parts = ",\n".join(f"{n} AS {once}(\n{b}\n)" for n, b in self.ctes)
        return f"WITH {parts}\n{select}"


# ----------------------------------------------------------------------------- inputs

def signals_tpch(b: SqlBuilder) -> str:
    return b.add(
        "sig_tpch",
        """SELECT CAST(o.o_custkey AS VARCHAR) AS "user", CAST(l.l_partkey AS VARCHAR) AS item,
       CASE WHEN l.l_returnflag = 'R' THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS weight,
       l.l_returnflag AS signal_type
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    )


def signals_union(b: SqlBuilder) -> str:
    return b.add(
        "sig_union",
        """SELECT CAST(o.o_custkey AS VARCHAR) AS "user", CAST(l.l_partkey AS VARCHAR) AS item, 1.0::DOUBLE AS weight
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey WHERE l.l_returnflag <> 'R'
UNION ALL
SELECT CAST(o.o_custkey AS VARCHAR), CAST(l.l_partkey AS VARCHAR), 0.5::DOUBLE
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey WHERE l.l_returnflag = 'R'""",
    )


def signals_events(b: SqlBuilder, signed: bool = False) -> str:
    name = "sig_signed" if signed else "sig_events"
    extra = "WHEN 'error' THEN -0.5::DOUBLE " if signed else ""
    types = "'purchase', 'click', 'view'" + (", 'error'" if signed else "")
    return b.add(
        name,
        f"""SELECT CAST(user_id AS VARCHAR) AS "user", json_extract_string(props, '$.k') AS item,
       CASE event_type WHEN 'purchase' THEN 1.0::DOUBLE WHEN 'click' THEN 0.5::DOUBLE
                       WHEN 'view' THEN 0.25::DOUBLE {extra}END AS weight,
       event_type AS signal_type
FROM events WHERE event_type IN ({types})""",
    )


def metadata(b: SqlBuilder) -> str:
    return b.add(
        "md",
        """SELECT CAST(p_partkey AS VARCHAR) AS item, p_type AS metadata_field FROM part WHERE p_size <= 45
UNION ALL
SELECT CAST(p_partkey AS VARCHAR), p_brand FROM part WHERE p_size <= 10""",
    )


def source_items(b: SqlBuilder) -> str:
    return b.add("src_items", "SELECT DISTINCT CAST(p_partkey AS VARCHAR) AS item FROM part WHERE p_size <= 25")


def dest_items(b: SqlBuilder) -> str:
    return b.add("dst_items", "SELECT DISTINCT CAST(p_partkey AS VARCHAR) AS item FROM part WHERE p_size % 2 = 0")


def item_item_signals(b: SqlBuilder) -> str:
    b.add(
        "iis_pairs",
        """SELECT CAST(a.l_partkey AS VARCHAR) AS item_A, CAST(c.l_partkey AS VARCHAR) AS item_B,
       CASE WHEN a.l_returnflag = 'R' OR c.l_returnflag = 'R' THEN -0.25 ELSE 0.25 END AS w
FROM lineitem a JOIN lineitem c
  ON a.l_orderkey = c.l_orderkey AND c.l_linenumber = a.l_linenumber + 1
WHERE a.l_partkey <> c.l_partkey""",
    )
    return b.add(
        "iis",
        """SELECT item_A, item_B, SUM(w) AS weight FROM (
  SELECT item_A, item_B, w FROM iis_pairs UNION ALL SELECT item_B, item_A, w FROM iis_pairs
) GROUP BY item_A, item_B""",
    )


# ----------------------------------------------------------------------------- graph

def ui_scaled(b: SqlBuilder, sig: str, p: RecParams, detail: bool = False) -> str:
    k = _num(p.logistic_param)
    name = f"ui_{sig}" + ("_d" if detail else "")
    if not detail:
        b.add(
            f"{name}_sum",
            f"""SELECT "user", item, {dbl(f"CAST(SUM({units('weight')}) AS BIGINT)")} AS w FROM {sig}
WHERE "user" IS NOT NULL AND item IS NOT NULL GROUP BY "user", item""",
        )
    else:
        b.add(
            f"{name}_types",
            f"""SELECT "user", item, signal_type, SUM({units('weight')}) AS wt, COUNT(*) AS n FROM {sig}
WHERE "user" IS NOT NULL AND item IS NOT NULL GROUP BY "user", item, signal_type""",
        )
        b.add(
            f"{name}_sum",
            f"""SELECT "user", item, {dbl("CAST(SUM(wt) AS BIGINT)")} AS w FROM {name}_types GROUP BY "user", item""",
        )
    return b.add(
        name,
        f"""SELECT "user", item,
       {units(f"2.0::DOUBLE / (1.0::DOUBLE + EXP(-{k}::DOUBLE * w)) - 1.0::DOUBLE")} AS weight
FROM {name}_sum WHERE w IS NOT NULL""",
    )


def item_weights(b: SqlBuilder, ui: str) -> str:
    return b.add(f"iw_{ui}", f"SELECT item, CAST(SUM(weight) AS BIGINT) AS overall_weight FROM {ui} GROUP BY item")


def capped(b: SqlBuilder, ui: str, iw: str, p: RecParams) -> str:
    return b.add(
        f"cap_{ui}",
        f"""SELECT "user", item, weight FROM (
  SELECT u.*, ROW_NUMBER() OVER (PARTITION BY "user" ORDER BY weight DESC, item ASC) AS rn
  FROM {ui} u WHERE item IN (SELECT item FROM {iw} WHERE overall_weight >= {_units(p.min_link_weight)})
) WHERE rn <= {int(p.max_links_per_user)}""",
    )


def pairs(b: SqlBuilder, cap: str) -> str:
    return b.add(
        f"pairs_{cap}",
        f"""SELECT a."user", a.item AS item_A, c.item AS item_B, LEAST(a.weight, c.weight) AS w
FROM {cap} a JOIN {cap} c ON a."user" = c."user" AND a.item <> c.item""",
    )


def links_raw(b: SqlBuilder, pr: str, p: RecParams) -> str:
    return b.add(
        f"links_{pr}",
        f"""SELECT item_A, item_B, CAST(SUM(w) AS BIGINT) AS weight FROM {pr} GROUP BY item_A, item_B
HAVING SUM(w) >= {_units(p.min_link_weight)}""",
    )


class Graph:
    """Names of the CTEs of one built item-item graph."""

    def __init__(self, b: SqlBuilder, sig: str, p: RecParams, detail: bool = False):
        self.ui = ui_scaled(b, sig, p, detail)
        self.iw = item_weights(b, self.ui)
        self.cap = capped(b, self.ui, self.iw, p)
        self.pairs = pairs(b, self.cap)
        self.links = links_raw(b, self.pairs, p)
        self.detail = detail
        if detail:
            types = b.add(
                f"types_{self.ui}",
                f"""SELECT "user", item, signal_type, n FROM {self.ui}_types
WHERE signal_type IS NOT NULL""",
            )
            b.add(
                f"ld_{self.ui}",
                f"""SELECT pr.item_A, pr.item_B, t.signal_type AS k, t.n FROM {self.pairs} pr
  JOIN {types} t ON t."user" = pr."user" AND t.item = pr.item_A
UNION ALL
SELECT pr.item_A, pr.item_B, t.signal_type, t.n FROM {self.pairs} pr
  JOIN {types} t ON t."user" = pr."user" AND t.item = pr.item_B
UNION ALL
SELECT item_A, item_B, 'NUM_USERS', 1 FROM {self.pairs}""",
            )
            self.link_data = b.add(
                f"lds_{self.ui}",
                f"""SELECT d.item_A, d.item_B, d.k AS signal_type, CAST(SUM(d.n) AS BIGINT) AS n
FROM ld_{self.ui} d JOIN {self.links} l ON l.item_A = d.item_A AND l.item_B = d.item_B
GROUP BY d.item_A, d.item_B, d.k""",
            )


def adjust(b: SqlBuilder, links: str, iw: str, p: RecParams, boost: str | None = None) -> str:
    ow = dbl("iw.overall_weight")
    w = dbl("l.weight")
    if boost is None:
        num, tag = w, "bayes"
    else:
        f = boost.upper()
        fx = {"SQRT": f"SQRT({ow})", "LOG": f"ROUND(LN({ow}), 9)", "": ow}[f]
        num, tag = f"({w} * {fx})", f"boost_{f.lower() or 'linear'}"
    return b.add(
        f"{tag}_{links}",
        f"""SELECT l.item_A, l.item_B, {num} / ({ow} + {_num(p.bayesian_prior)}::DOUBLE) AS weight, {w} AS raw_weight
FROM {links} l JOIN {iw} iw ON iw.item = l.item_B""",
    )


def prune(b: SqlBuilder, adj: str, nhood: int) -> str:
    return b.add(
        f"g{nhood}_{adj}",
        f"""SELECT item_A, item_B, dist, raw_weight FROM (
  SELECT item_A, item_B, 1.0::DOUBLE / weight AS dist, raw_weight,
         ROW_NUMBER() OVER (PARTITION BY item_A ORDER BY 1.0::DOUBLE / weight ASC, item_B ASC) AS rn
  FROM {adj} WHERE weight IS NOT NULL AND weight <> 0
) WHERE rn <= {int(nhood)}""",
    )


def paths_seed(b: SqlBuilder, g: str, dst: str | None = None) -> str:
    where = f"WHERE item_B IN (SELECT item FROM {dst})" if dst else ""
    return b.add(
        f"paths_{g}" + ("_dst" if dst else ""),
        f"""SELECT * FROM (
  SELECT item_A, item_B, dist, CAST(NULL AS DOUBLE) AS raw_weight FROM {g}
  UNION ALL
  SELECT item_B, item_B, 0.0::DOUBLE, CAST(NULL AS DOUBLE) FROM (SELECT DISTINCT item_B FROM {g})
) {where}""",
    )


def path_recs(
    b: SqlBuilder, adj: str, nhood: int, num_recs: int, src: str | None = None, dst: str | None = None
) -> str:
    """Shortest <=2-hop paths the way the reference states them: graph JOIN paths."""
    g = prune(b, adj, nhood)
    gs = g if src is None else b.add(f"{g}_src", f"SELECT * FROM {g} WHERE item_A IN (SELECT item FROM {src})")
    pth = paths_seed(b, g, dst)
    steps = b.add(
        f"steps_{gs}_{pth}",
        f"""SELECT g.item_A, pt.item_B, g.dist + pt.dist AS dist,
       CASE WHEN pt.item_A = pt.item_B THEN g.raw_weight ELSE pt.raw_weight END AS raw_weight,
       CASE WHEN pt.item_A = pt.item_B THEN 0 ELSE 1 END AS hop,
       CASE WHEN pt.item_A <> pt.item_B THEN g.item_B END AS linking_item
FROM {gs} g JOIN {pth} pt ON g.item_B = pt.item_A""",
    )
    best = b.add(
        f"best_{steps}",
        f"""SELECT * FROM (
  SELECT s.*, ROW_NUMBER() OVER (PARTITION BY item_A, item_B
         ORDER BY dist ASC, hop ASC, linking_item ASC NULLS FIRST, raw_weight DESC NULLS LAST) AS rn
  FROM {steps} s
) WHERE rn = 1 AND item_A <> item_B""",
    )
    return b.add(
        f"recs{num_recs}_{best}",
        f"""SELECT item_A, item_B, 1.0::DOUBLE / dist AS weight, raw_weight, CAST(rn2 AS INTEGER) AS "rank",
       linking_item
FROM (
  SELECT x.*, ROW_NUMBER() OVER (PARTITION BY item_A ORDER BY dist ASC, item_B ASC) AS rn2 FROM {best} x
) WHERE rn2 <= {int(num_recs)}""",
    )


def diversify(b: SqlBuilder, adj: str, md: str) -> str:
    return b.add(
        f"div_{adj}",
        f"""SELECT a.item_A, a.item_B,
       a.weight / CAST(ROW_NUMBER() OVER (PARTITION BY a.item_A, m.metadata_field
                                         ORDER BY a.weight DESC, a.item_B ASC) AS DOUBLE) AS weight,
       a.raw_weight
FROM {adj} a JOIN {md} m ON m.item = a.item_B""",
    )


def sum_signals(b: SqlBuilder, links: str, iw: str, iis: str) -> tuple[str, str]:
    ox = b.add(
        f"ox_{iis}",
        f"SELECT item_A AS item, CAST(SUM({units('weight')}) AS BIGINT) AS ox FROM {iis} GROUP BY item_A",
    )
    iw2 = b.add(
        f"iw2_{iw}",
        f"""SELECT item, CASE WHEN t < 0 THEN 0 ELSE t END AS overall_weight FROM (
  SELECT COALESCE(w.item, e.item) AS item, COALESCE(w.overall_weight, 0) + COALESCE(e.ox, 0) AS t
  FROM {iw} w FULL OUTER JOIN {ox} e ON w.item = e.item
)""",
    )
    links2 = b.add(
        f"l2_{links}",
        f"""SELECT * FROM (
  SELECT COALESCE(l.item_A, s.item_A) AS item_A, COALESCE(l.item_B, s.item_B) AS item_B,
         COALESCE(l.weight, 0) + COALESCE({units('s.weight')}, 0) AS weight
  FROM {links} l FULL OUTER JOIN {iis} s ON l.item_A = s.item_A AND l.item_B = s.item_B
) WHERE weight > 0""",
    )
    return links2, iw2


def user_recs(b: SqlBuilder, sig: str, recs: str, p: RecParams, diversity: bool) -> str:
    seen = b.add(
        f"seen_{sig}",
        f"""SELECT "user", item, MAX(weight) AS sw FROM {sig}
WHERE "user" IS NOT NULL AND item IS NOT NULL GROUP BY "user", item""",
    )
    cand = b.add(
        f"ucand_{recs}",
        f"""SELECT s."user", r.item_B AS item, SQRT(GREATEST(COALESCE(s.sw, 0.0), 0.0) * r.weight) AS weight,
       s.item AS reason_item, s.sw AS user_reason_item_weight, r.raw_weight AS item_reason_item_weight
FROM {seen} s JOIN {recs} r ON s.item = r.item_A""",
    )
    best = b.add(
        f"ubest_{recs}",
        f"""SELECT * EXCLUDE (rn) FROM (
  SELECT c.*, ROW_NUMBER() OVER (PARTITION BY "user", item ORDER BY weight DESC, reason_item ASC) AS rn
  FROM {cand} c
) x WHERE rn = 1
  AND NOT EXISTS (SELECT 1 FROM {seen} s WHERE s."user" = x."user" AND s.item = x.item)""",
    )
    if diversity:
        adj = """weight / CAST(ROW_NUMBER() OVER (PARTITION BY "user", reason_item
                                           ORDER BY weight DESC, item ASC) + 1 AS DOUBLE)"""
    else:
        adj = "weight"
    scored = b.add(f"uscored_{recs}_{int(diversity)}", f"SELECT u.*, {adj} AS adj FROM {best} u")
    return b.add(
        f"urecs_{recs}_{int(diversity)}",
        f"""SELECT "user", item, weight, reason_item, user_reason_item_weight, item_reason_item_weight,
       CAST(rn AS INTEGER) AS "rank"
FROM (
  SELECT s.*, ROW_NUMBER() OVER (PARTITION BY "user" ORDER BY adj DESC, item ASC) AS rn FROM {scored} s
) WHERE rn <= {int(p.num_recs_per_user)}""",
    )


# ----------------------------------------------------------------------------- catalogue

REC_COLS = "item_A, item_B, weight, raw_weight, \"rank\""
UREC_COLS = '"user", item, weight, reason_item, user_reason_item_weight, item_reason_item_weight, "rank"'


def _tpch_graph(b: SqlBuilder, p: RecParams = PARAMS_T, detail: bool = False) -> Graph:
    return Graph(b, signals_tpch(b), p, detail)


def _q(fn) -> str:
    b = SqlBuilder()
    sel = fn(b)
    return b.render(sel)


def build_oracle_sql() -> dict[str, str]:
    T, E = PARAMS_T, PARAMS_E
    N = T.num_recs_per_item
    out: dict[str, str] = {}

    out["signals_union"] = _q(lambda b: f'SELECT "user", item, weight FROM {signals_union(b)}')
    out["json_signals"] = out["signals_union"]
    joined = "FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey WHERE l.l_linenumber"
    out["json_signals_quarantined"] = f"""SELECT CAST(o.o_custkey AS VARCHAR) AS "user", CAST(l.l_partkey AS VARCHAR) AS item,
  CASE WHEN l.l_returnflag = 'R' THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS weight {joined} <> 7
UNION ALL
SELECT CASE WHEN l.l_returnflag = 'R' THEN 'bad wishlists' ELSE 'bad purchases' END, NULL, CAST(COUNT(*) AS DOUBLE)
{joined} = 7 GROUP BY 1"""
    out["explode_metadata"] = _q(
        lambda b: """SELECT CAST(p_partkey AS VARCHAR) AS item, UNNEST(string_split(p_name, ' ')) AS metadata_field
FROM part"""
    )
    out["remove_bots"] = _q(
        lambda b: f"""SELECT "user", item, weight FROM {signals_tpch(b)}
WHERE "user" IN (SELECT "user" FROM {signals_tpch(b)} GROUP BY "user" HAVING COUNT(*) < 40)"""
    )
    out["ui_scaled"] = _q(
        lambda b: f'SELECT "user", item, {dbl("weight")} AS weight FROM {_tpch_graph(b).ui}'
    )
    out["item_weights"] = _q(
        lambda b: f"SELECT item, {dbl('overall_weight')} AS overall_weight FROM {_tpch_graph(b).iw}"
    )
    out["top_links_per_user"] = _q(
        lambda b: f'SELECT "user", item, {dbl("weight")} AS weight FROM {_tpch_graph(b).cap}'
    )
    out["item_item_links"] = _q(
        lambda b: f"SELECT item_A, item_B, {dbl('weight')} AS weight FROM {_tpch_graph(b).links}"
    )

    def bayes(b):
        g = _tpch_graph(b)
        return adjust(b, g.links, g.iw, T)

    out["bayes_links"] = _q(lambda b: f"SELECT item_A, item_B, weight, raw_weight FROM {bayes(b)}")
    for key, f in (("pop_boost_sqrt", "SQRT"), ("pop_boost_log", "LOG"), ("pop_boost_linear", "")):
        out[key] = _q(
            lambda b, f=f: (
                lambda g: f"SELECT item_A, item_B, weight, raw_weight FROM {adjust(b, g.links, g.iw, T, f)}"
            )(_tpch_graph(b))
        )
    out["links_metadata"] = _q(
        lambda b: (
            lambda g, md: f"""SELECT l.item_A, l.item_B, {dbl('l.weight')} AS weight,
       ma.metadata_field AS metadata_A, mb.metadata_field AS metadata_B
FROM {g.links} l JOIN {md} ma ON ma.item = l.item_A JOIN {md} mb ON mb.item = l.item_B"""
        )(_tpch_graph(b), metadata(b))
    )
    out["diversified_links"] = _q(
        lambda b: f"SELECT item_A, item_B, weight, raw_weight FROM {diversify(b, bayes(b), metadata(b))}"
    )

    def summed(b):
        g = _tpch_graph(b)
        return sum_signals(b, g.links, g.iw, item_item_signals(b))

    out["sum_item_item_links"] = _q(
        lambda b: f"SELECT item_A, item_B, {dbl('weight')} AS weight FROM {summed(b)[0]}"
    )
    out["sum_item_item_weights"] = _q(
        lambda b: f"SELECT item, {dbl('overall_weight')} AS overall_weight FROM {summed(b)[1]}"
    )
    out["direct_recs"] = _q(
        lambda b: f"""SELECT item_A, item_B, weight, raw_weight, CAST(rn AS INTEGER) AS "rank" FROM (
  SELECT a.*, ROW_NUMBER() OVER (PARTITION BY item_A ORDER BY weight DESC, item_B ASC) AS rn
  FROM {bayes(b)} a WHERE weight IS NOT NULL
) WHERE rn <= {N}"""
    )
    nh = PATH_NHOOD
    out["graph_pruned"] = _q(lambda b: f"SELECT item_A, item_B, dist, raw_weight FROM {prune(b, bayes(b), nh)}")
    out["paths_seed"] = _q(
        lambda b: f"SELECT item_A, item_B, dist, raw_weight FROM {paths_seed(b, prune(b, bayes(b), nh))}"
    )
    out["path_recs"] = _q(lambda b: f"SELECT {REC_COLS} FROM {path_recs(b, bayes(b), nh, N)}")
    out["available_graph"] = _q(
        lambda b: f"""SELECT item_A, item_B, dist, raw_weight FROM {prune(b, bayes(b), nh)}
WHERE item_A IN (SELECT item FROM {source_items(b)})"""
    )
    out["available_paths"] = _q(
        lambda b: f"SELECT item_A, item_B, dist, raw_weight FROM {paths_seed(b, prune(b, bayes(b), nh), dest_items(b))}"
    )
    out["available_path_recs"] = _q(
        lambda b: f"SELECT {REC_COLS} FROM {path_recs(b, bayes(b), nh, N, source_items(b), dest_items(b))}"
    )

    # detailed mode
    out["available_recs_mapped_lists"] = out["available_path_recs"]

    def dgraph(b):
        return _tpch_graph(b, T, detail=True)

    def detailed_links(b):
        # One row a link; its map as text, by key.
        b.materialize = True
        g = dgraph(b)
        data = b.add(
            "link_texts",
            f"""SELECT item_A, item_B, string_agg(signal_type || '=' || n, ',' ORDER BY signal_type) AS link_data
FROM {g.link_data} GROUP BY item_A, item_B""",
        )
        return f"""SELECT l.item_A, l.item_B, {dbl('l.weight')} AS weight, d.link_data
FROM {g.links} l JOIN {data} d ON d.item_A = l.item_A AND d.item_B = l.item_B"""

    out["detailed_links"] = _q(detailed_links)
    out["detailed_bayes_links"] = _q(
        lambda b: (
            lambda g: f"""SELECT a.item_A, a.item_B, a.weight, a.raw_weight, d.signal_type, d.n
FROM {adjust(b, g.links, g.iw, T)} a JOIN {g.link_data} d ON d.item_A = a.item_A AND d.item_B = a.item_B"""
        )(dgraph(b))
    )
    out["detailed_graph"] = _q(
        lambda b: (
            lambda g: f"""SELECT x.item_A, x.item_B, x.dist, x.raw_weight, d.signal_type, d.n
FROM {prune(b, adjust(b, g.links, g.iw, T), nh)} x
JOIN {g.link_data} d ON d.item_A = x.item_A AND d.item_B = x.item_B"""
        )(dgraph(b))
    )
    out["detailed_path_recs"] = _q(
        lambda b: (
            lambda g: f"""SELECT {REC_COLS}, linking_item FROM {path_recs(b, adjust(b, g.links, g.iw, T), nh, N)}"""
        )(dgraph(b))
    )
    out["detailed_path_recs_data"] = _q(
        lambda b: (
            lambda g: f"""SELECT r.item_A, r.item_B, r."rank", d.signal_type, d.n
FROM {path_recs(b, adjust(b, g.links, g.iw, T), nh, N)} r
JOIN {g.link_data} d ON d.item_A = r.item_A AND d.item_B = r.item_B
WHERE r.linking_item IS NULL"""
        )(dgraph(b))
    )
    out["item_item_recs_detailed"] = _q(
        lambda b: (
            lambda g: f"""SELECT r.item_A, r.item_B, r.weight, r.raw_weight, r."rank", r.linking_item, d.n AS num_users
FROM {path_recs(b, adjust(b, g.links, g.iw, T), N, N)} r
LEFT JOIN {g.link_data} d ON d.item_A = r.item_A AND d.item_B = r.item_B AND d.signal_type = 'NUM_USERS'
  AND r.linking_item IS NULL"""
        )(dgraph(b))
    )

    # composed recommenders (neighbourhood = number of recs, as the reference passes them)
    out["item_item_recs"] = _q(lambda b: f"SELECT {REC_COLS} FROM {path_recs(b, bayes(b), N, N)}")

    def title(c):
        n = f"CAST({c} AS BIGINT) % 8"
        return f"""CASE {n} WHEN 0 THEN '  ' || {c} || ' ' WHEN 1 THEN '"' || {c} || '" ''x'''
       WHEN 2 THEN {c} || chr(9) || {c} WHEN 3 THEN {c} || chr(10) || {c} || chr(13)
       WHEN 4 THEN chr(92) || 't' || chr(92) || 'N' || chr(92) || {c} WHEN 5 THEN '' WHEN 6 THEN NULL ELSE {c} END"""

    out["text_sink_roundtrip"] = _q(
        lambda b: f"SELECT {REC_COLS}, {title('item_A')} AS title_A, {title('item_B')} AS title_B "
        f"FROM {path_recs(b, bayes(b), N, N)}"
    )
    out["item_item_recs_add_signals"] = _q(
        lambda b: (
            lambda g, s: f"""SELECT {REC_COLS} FROM {path_recs(b, adjust(b, s[0], s[1], T), N, N)}
WHERE item_A IS NOT NULL AND item_B IS NOT NULL AND weight IS NOT NULL AND "rank" IS NOT NULL"""
        )(*(lambda g: (g, sum_signals(b, g.links, g.iw, item_item_signals(b))))(_tpch_graph(b)))
    )
    out["item_item_recs_diversified"] = _q(
        lambda b: f"SELECT {REC_COLS} FROM {path_recs(b, diversify(b, bayes(b), metadata(b)), N, N)}"
    )
    out["item_item_recs_available"] = _q(
        lambda b: f"SELECT {REC_COLS} FROM {path_recs(b, bayes(b), N, N, source_items(b), dest_items(b))}"
    )
    out["item_item_recs_in_stock"] = _q(
        lambda b: "SELECT {} FROM {}".format(
            REC_COLS,
            path_recs(
                b,
                bayes(b),
                N,
                N,
                None,
                b.add("in_stock", "SELECT CAST(p_partkey AS VARCHAR) AS item FROM part WHERE p_size % 4 > 0"),
            ),
        )
    )
    out["item_item_recs_pop_boost"] = _q(
        lambda b: (
            lambda g: f"SELECT {REC_COLS} FROM {path_recs(b, adjust(b, g.links, g.iw, T, 'SQRT'), N, N)}"
        )(_tpch_graph(b))
    )

    # user recs
    out["refine_user_recs"] = _q(
        lambda b: f"SELECT {UREC_COLS} FROM {user_recs(b, signals_tpch(b), path_recs(b, bayes(b), nh, N), T, False)}"
    )
    out["refine_user_recs_diverse"] = _q(
        lambda b: f"SELECT {UREC_COLS} FROM {user_recs(b, signals_tpch(b), path_recs(b, bayes(b), nh, N), T, True)}"
    )
    out["user_item_recs"] = _q(
        lambda b: f"SELECT {UREC_COLS} FROM {user_recs(b, signals_tpch(b), path_recs(b, bayes(b), N, N), T, False)}"
    )

    def example_job(b):
        recs = path_recs(b, bayes(b), N, N)
        users = user_recs(b, signals_tpch(b), recs, T, False)
        return f"""SELECT 'item' AS kind, item_A AS key, item_B AS item, weight, CAST(NULL AS VARCHAR) AS reason,
       CAST(NULL AS DOUBLE) AS reason_weight, raw_weight, "rank" FROM {recs}
UNION ALL
SELECT 'user', "user", item, weight, reason_item, user_reason_item_weight, item_reason_item_weight, "rank" FROM {users}"""

    out["example_job"] = _q(example_job)
    # What a killed and resumed job publishes is what an uninterrupted one does.
    out["example_job_resumed"] = out["example_job"]

    def events_recs(b, signed):
        sig = signals_events(b, signed)
        g = Graph(b, sig, E)
        return sig, path_recs(b, adjust(b, g.links, g.iw, E), E.initial_nhood_size, E.num_recs_per_item)

    out["item_item_recs_events"] = _q(lambda b: f"SELECT {REC_COLS} FROM {events_recs(b, False)[1]}")
    out["user_item_recs_signed"] = _q(
        lambda b: (lambda s, r: f"SELECT {UREC_COLS} FROM {user_recs(b, s, r, E, False)}")(*events_recs(b, True))
    )
    return out
