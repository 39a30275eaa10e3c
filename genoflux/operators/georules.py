"""Wildcard location rules: four-level lookup and rule application to a
fixpoint, as joins over the *distinct* location tuples.

Rule semantics (shallow merge): at each level the exact child and the ``*``
child of the current node are merged, the exact branch winning on a shared
next key, with no backtracking.  Equivalently the walk carries at most two
trie nodes -- ``a`` (preferred) and ``b`` (fallback); for key ``k``:

    full = child(a, k) or child(b, k);  wild = child(a, '*') or child(b, '*')
    neither -> no rule;  next (a, b) = (full, wild) if full else (wild, none)

and at the last level the rule of ``full or wild`` applies.  The nodes are a
table of rule prefixes, written once; each carries how far ``*`` children go
on below it, so only exact children are looked up: at most two broadcast
joins a level and one for the rule at the leaf.  A lookup adds columns to a
row; nothing is expanded, aggregated or shuffled.

Resolution loops over the tuples that still change (up to two applications
per round in one plan, each round written as a stage table to the shared
folder, one small aggregate per round to decide whether to go on), and walks
the few that are left after some rounds by one recursive query; more
than 1000 applications on one tuple, or a tuple that provably cycles, is
reported as a rule cycle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.location import GEO_LEVELS, geo_normalise
from ..functions.text import empty_to_null
from ..session import BROADCAST_MAX_BYTES, cut_lineage, maybe_broadcast

SEP = "\u0001"
ROOT = ""
MAX_APPLICATIONS = 1000
#: Rounds before, and tuples up to which, the rest is walked by a recursive query.
ROUNDS, WALK_ROWS = 3, 100_000
_LEVELS = 4


def parse_rules(lines: DataFrame, value: str = "value", ordinal: str | None = "ordinal") -> DataFrame:
    """Rule text lines ``left<TAB>right`` (each side four ``/`` parts) ->
    ``(l0..l3, r0..r3)``.  Left sides are lower-cased; right sides are kept
    verbatim; a malformed line fails the job; for a repeated left side the
    last line wins."""
    v = F.col(value)
    sides = F.split(v, "\t", -1)
    left = F.split(F.lower(F.get(sides, 0)), "/", -1)
    right = F.split(F.get(sides, 1), "/", -1)
    bad = (F.size(sides) != 2) | (F.size(left) != 4) | (F.size(right) != 4)
    checked = F.when(bad, F.raise_error(F.concat(F.lit("malformed location rule: "), v)).cast("string"))
    cols = [F.get(left, i).alias(f"l{i}") for i in range(4)] + \
           [F.get(right, i).alias(f"r{i}") for i in range(4)]
    ords = [F.col(ordinal).alias("_ord")] if ordinal else [F.monotonically_increasing_id().alias("_ord")]
    parsed = lines.select(*cols, *ords, checked.alias("_check"))
    right_struct = F.struct(*[F.col(f"r{i}") for i in range(4)])
    # max_by evaluates _check on every row, so validation cannot be pruned.
    last = (parsed.groupBy(*[f"l{i}" for i in range(4)])
            .agg(F.max_by(right_struct, "_ord").alias("r"), F.max("_check").alias("_check")))
    return last.select(*[f"l{i}" for i in range(4)], *[F.col(f"r.r{i}").alias(f"r{i}") for i in range(4)],
                       F.col("_check").isNull().alias("_ok")).where("_ok").drop("_ok")


def rules_from_pairs(spark, pairs) -> DataFrame:
    """Rules given as ``[(left, right), ...]`` text pairs (a user parameter)."""
    lines = [(f"{lft}\t{rgt}", i) for i, (lft, rgt) in enumerate(pairs)]
    return parse_rules(spark.createDataFrame(lines, "value string, ordinal long"))


def prefix_table(rules: DataFrame) -> DataFrame:
    """Every rule-prefix path (the root's is empty, a child's is its
    parent's, ``SEP`` and the key) with ``wild``, the number of ``*`` children
    in a row below it, and the rule's right side for complete paths."""
    none = F.lit(None).cast("struct<r0:string,r1:string,r2:string,r3:string>")
    rows = rules.select(F.lit(ROOT).alias("path"), none.alias("right"))
    for d in range(1, _LEVELS + 1):
        path = F.concat(*[F.concat(F.lit(SEP), F.col(f"l{i}")) for i in range(d)])
        right = F.struct(*[F.col(f"r{i}") for i in range(4)]) if d == _LEVELS else none
        rows = rows.unionByName(rules.select(path.alias("path"), right.alias("right")))
    nodes = rows.groupBy("path").agg(F.first("right", ignorenulls=True).alias("right"))
    # a path that ends in n wild keys makes its n-th ancestor's run at least n
    runs = nodes.select(F.explode(F.expr(
        f"filter(transform(sequence(0, {_LEVELS}), n -> struct(n AS wild, "
        f"if(endswith(path, repeat('{SEP}*', n)), "
        f"substring(path, 1, length(path) - 2 * n), NULL) AS path)), s -> s.path IS NOT NULL)"
    )).alias("run")).groupBy("run.path").agg(F.max("run.wild").alias("wild"))
    return nodes.join(runs, "path").select("path", "wild", "right")


@dataclass
class Nodes:
    """The written prefix table; it grows with the rule file only (at most
    four rows a rule) and its measured size decides how it is joined."""
    table: DataFrame
    hint: str
    root_wild: int | None


def _nodes(prefixes: DataFrame, broadcast_rules: bool = True) -> Nodes:
    table = cut_lineage(prefixes, "geo-prefixes")
    r = table.agg(F.sum(F.octet_length("path") + F.coalesce(F.octet_length(F.to_json("right")), F.lit(0)) + 24),
                  F.max(F.when(F.col("path") == ROOT, F.col("wild")))).first()
    small = broadcast_rules and (r[0] or 0) <= BROADCAST_MAX_BYTES
    return Nodes(table, "BROADCAST" if small else "MERGE", r[1])


def _rule_sql(source: str, columns: list[str], nodes: Nodes, key_cols: list[str]) -> str:
    """A query that adds ``rule`` (right side struct, null if none) for the
    tuple in ``key_cols`` to the rows of ``source`` by the two-node walk.  One
    SQL text, analysed once: as some twenty frame operations, each analysed
    over all before it, the plan took longer to build than to run."""
    carried = ", ".join(f"`{c}`" for c in columns)
    root = "CAST(NULL AS STRING)" if nodes.root_wild is None else f"'{ROOT}'"
    wild = "NULL" if nodes.root_wild is None else str(nodes.root_wild)
    at = (f"SELECT {carried}, {root} AS _a, CAST({wild} AS INT) AS _a_w, "
          f"CAST(NULL AS STRING) AS _b, CAST(NULL AS INT) AS _b_w FROM {source}")
    for level, key in enumerate(key_cols):
        # the walk starts from one node
        second = f"LEFT JOIN {{nodes}} fb ON concat(_b, '{SEP}', lower(`{key}`)) = fb.path" if level else ""
        full = "coalesce(fa.path, fb.path)" if level else "fa.path"
        full_w = "if(fa.path IS NOT NULL, fa.wild, fb.wild)" if level else "fa.wild"
        at = f"""
          SELECT {carried}, coalesce(_f, _w) AS _a, if(_f IS NOT NULL, _f_w, _w_w) AS _a_w,
                 if(_f IS NOT NULL, _w, NULL) AS _b, if(_f IS NOT NULL, _w_w, NULL) AS _b_w
          FROM (SELECT /*+ {nodes.hint}(fa{', fb' if level else ''}) */ {carried}, {full} AS _f, {full_w} AS _f_w,
                       CASE WHEN _a_w > 0 THEN concat(_a, '{SEP}*') WHEN _b_w > 0 THEN concat(_b, '{SEP}*') END AS _w,
                       CASE WHEN _a_w > 0 THEN _a_w - 1 WHEN _b_w > 0 THEN _b_w - 1 END AS _w_w
                FROM ({at}) LEFT JOIN {{nodes}} fa ON concat(_a, '{SEP}', lower(`{key}`)) = fa.path {second})"""
    return f"""
      SELECT /*+ {nodes.hint}(leaf) */ {carried}, leaf.right AS rule
      FROM ({at}) LEFT JOIN (SELECT path, right FROM {{nodes}} WHERE right IS NOT NULL) leaf ON _a = leaf.path"""


def _rule_for(rows: DataFrame, nodes: Nodes, key_cols: list[str]) -> DataFrame:
    return rows.sparkSession.sql(_rule_sql("{rows}", rows.columns, nodes, key_cols), rows=rows, nodes=nodes.table)


def lookup(tuples: DataFrame, prefixes: DataFrame, cols=("c0", "c1", "c2", "c3"),
           broadcast_rules: bool = True) -> DataFrame:
    """For distinct normalised tuples, the applicable rule's right side
    (struct r0..r3, null if none)."""
    return _rule_for(tuples.select(*cols), _nodes(prefixes, broadcast_rules), list(cols))


#: Columns of a tuple's way: the given tuple, the current one, the saved one,
#: how often a rule changed it, and what its last application told.
_STATE = [*(f"{k}{i}" for k in "cns" for i in range(4)), "steps", "_chg", "_cycseen"]


def _step_sql(source: str, nodes: Nodes) -> str:
    """One rule application to every row of ``source`` (``_STATE``): ``_chg``
    tells whether the current tuple changed, ``_cycseen`` whether it came back
    to the saved tuple ``s`` (Brent's cycle check: the saved tuple is
    refreshed whenever the step count reaches a power of two, so any cycle is
    seen within a small multiple of its length -- such a chain can never
    terminate, so it is reported without running to the application limit)."""
    given = [f"c{i}" for i in range(4)]
    nxt = [f"CASE WHEN rule IS NULL OR rule.r{i} = '*' THEN n{i} ELSE rule.r{i} END AS x{i}" for i in range(4)]
    kept = [*given, *(f"n{i}" for i in range(4)), *(f"s{i}" for i in range(4)), "steps", "_cycseen"]
    changed = " OR ".join(f"NOT (x{i} <=> n{i})" for i in range(4))
    back = " AND ".join(f"x{i} <=> s{i}" for i in range(4))
    saved = [f"if(chg AND ((steps + 1) & steps) = 0, x{i}, s{i}) AS s{i}" for i in range(4)]
    return f"""
      SELECT {", ".join(given)}, {", ".join(f"x{i} AS n{i}" for i in range(4))}, {", ".join(saved)},
             steps + CAST(chg AS INT) AS steps, chg AS _chg, _cycseen OR (chg AND back) AS _cycseen
      FROM (SELECT *, ({changed}) AS chg, ({back}) AS back
            FROM (SELECT {", ".join(kept)}, {", ".join(nxt)}
                  FROM ({_rule_sql(source, kept, nodes, [f"n{i}" for i in range(4)])})))"""


def _apply_once(state: DataFrame, nodes: Nodes) -> DataFrame:
    return state.sparkSession.sql(_step_sql("{rows}", nodes), rows=state, nodes=nodes.table)


def _walk_on(active: DataFrame, nodes: Nodes) -> DataFrame:
    """The last step of every tuple in ``active``, by one recursive query: a
    level applies the rules once to the tuples the level before changed.
    Every level's rows are kept until the end, so this is for what is left
    after the first rounds."""
    spark = active.sparkSession
    limits = {"spark.sql.cteRecursionLevelLimit": str(MAX_APPLICATIONS + 10), "spark.sql.cteRecursionRowLimit": "-1"}
    before = {k: spark.conf.get(k) for k in limits}
    columns = ", ".join(_STATE)
    going = f"_chg AND NOT _cycseen AND steps <= {MAX_APPLICATIONS}"
    try:
        for k, v in limits.items():
            spark.conf.set(k, v)
        walk = spark.sql(f"""
          WITH RECURSIVE walk({columns}) AS (
            SELECT {columns} FROM {{rows}}
            UNION ALL
            {_step_sql(f"(SELECT * FROM walk WHERE {going})", nodes)})
          SELECT {columns} FROM walk WHERE NOT ({going})""", rows=active.select(*_STATE), nodes=nodes.table)
        return cut_lineage(walk, "geo-walk")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def resolve_tuples(tuples: DataFrame, rules: DataFrame, per_round: int = 2) -> DataFrame:
    """Distinct normalised tuples ``(c0..c3)`` -> resolved ``(c0..c3, n0..n3)``
    after applying rules until the tuple no longer changes (case-sensitive)
    or no rule applies.

    A round applies the rules once at first (most tuples match no rule),
    then up to ``per_round`` times in one plan, and is written as a stage
    table to the shared folder; rows whose last application changed nothing
    are final, the others go on to the next round.  A small aggregate over the
    written round decides whether to continue.  All loop state lives in those
    files, so a lost executor costs at most the current round.  After
    ``ROUNDS`` rounds the tuples that still change, if they are few, are
    walked to their ends by one recursive query instead of a round for every
    two applications.  More than 1000 applications on one tuple, or a tuple
    that provably cycles, fails the job as cyclic rules."""
    nodes = _nodes(prefix_table(rules))
    cols = ["c0", "c1", "c2", "c3"]
    active = tuples.select(*cols, *[F.col(c).alias(f"n{i}") for i, c in enumerate(cols)],
                           *[F.col(c).alias(f"s{i}") for i, c in enumerate(cols)],
                           F.lit(0).alias("steps"), F.lit(True).alias("_chg"), F.lit(False).alias("_cycseen"))
    finished_parts, times, rounds, left = [], 1, 0, None
    while True:
        if rounds >= ROUNDS and left <= WALK_ROWS:
            step = _walk_on(active, nodes)
        else:
            step = active
            for _ in range(times):
                step = _apply_once(step, nodes)
            step = cut_lineage(step, "geo-round")
        times, rounds = min(2 * times, per_round), rounds + 1
        stats = step.agg(F.count_if("_chg").alias("n"), F.max("steps").alias("m"),
                         F.count_if("_cycseen").alias("c")).first()
        finished_parts.append(step.where(~F.col("_chg")).select(*cols, *[f"n{i}" for i in range(4)]))
        if stats["c"] or (stats["n"] and stats["m"] > MAX_APPLICATIONS):
            raise RuntimeError(
                f"location rules applied without end (more than {MAX_APPLICATIONS} "
                "applications would be needed); the rules are cyclic")
        left = stats["n"]
        if not left:
            break
        active = step.where("_chg")
    done = finished_parts[0]
    for p in finished_parts[1:]:
        done = done.unionByName(p)
    return done


def map_locations(df: DataFrame, rules: DataFrame, fields=GEO_LEVELS) -> DataFrame:
    """Normalise the four location columns (null -> "", Unicode trim),
    resolve the distinct tuples against the rules and turn "" into null.

    Only distinct tuples go through the rule loop, and only the tuples a rule
    actually rewrote are joined back: rows whose tuple no rule changes keep
    their normalised values without a join.  That rewritten-tuple mapping is
    what a rule file touches, typically far smaller than the set of all
    locations, so it is broadcast when its measured size allows and the wide
    rows (with their sequences) are never shuffled for it; otherwise a
    shuffled join, where AQE can split a hot tuple."""
    fields = list(fields)
    norm = [geo_normalise(F.col(f"`{f}`")) for f in fields]
    keyed = df.withColumns({f"_g{i}": n for i, n in enumerate(norm)})
    tuples = keyed.select(*[F.col(f"_g{i}").alias(f"c{i}") for i in range(4)]).distinct()
    resolved = resolve_tuples(tuples, rules)
    rewritten = F.lit(False)
    for i in range(4):
        rewritten = rewritten | ~F.col(f"n{i}").eqNullSafe(F.col(f"c{i}"))
    mapping = resolved.where(rewritten).select(
        *[F.col(f"c{i}").alias(f"_g{i}") for i in range(4)],
        *[F.col(f"n{i}").alias(f"_n{i}") for i in range(4)], F.lit(True).alias("_hit"))
    mapping = maybe_broadcast(mapping)
    out = keyed.join(mapping, [f"_g{i}" for i in range(4)], "left")
    out = out.withColumns({f: empty_to_null(F.when(F.col("_hit"), F.col(f"_n{i}"))
                                            .otherwise(F.col(f"_g{i}")))
                           for i, f in enumerate(fields)})
    return out.drop(*[f"_g{i}" for i in range(4)], *[f"_n{i}" for i in range(4)], "_hit") \
        .select(*[F.col(f"`{c}`") for c in df.columns])
