"""Tool-call linking for chat data, on DataFrame functions only.

1. Calls and results are reduced to one row per (conversation, identifier)
   -- the earliest turn counts, ``repeats`` tells how many more there were
   -- and hash-joined on that key.  Keys are unique then, so no conversation,
   however long, meets in one task.  With ``later_rows``, what a later call
   or result of the identifier says otherwise comes back as a row of status
   ``repeated``, and ``repeats`` counts equal rows only.
2. A call may need the results of other calls of its conversation (``after``,
   an identifier or an array of them); its level is one more than the highest
   of theirs.  Calls that need one other form a forest, levelled by pointer
   doubling: in each round every call adds the distance of the ancestor it
   points at and takes over that one's pointer, so a chain of n calls takes
   log2(n) rounds.  With arrays, chains are contracted so first, and the calls
   that need several are then peeled off in topological order, a round for
   each level of them.
   Calls on or behind a cycle are never reached and get level -1.  (level,
   turn, call_id) is a topological order of a conversation.
3. Arguments are parsed as VARIANT and checked against the tool's schema
   (type, range, required, no unknown names), numbers by their value: 1e2 and
   100.0 are integers.
4. Each call becomes one canonical JSON record: keys in order, no white
   space, and one form for all numbers of equal value: plain digits without
   needless zeros, or from 40 digits on d.ddde+n.  Integers and decimals of
   up to 38 digits are exact, others are the nearest double.

Defined cases: a null conversation is one conversation; rows without an
identifier are left out of linking and returned as status ``unidentified``;
a result without call is ``orphan``, a call without result ``unanswered``;
``after`` an unknown call counts as none and is reported in ``errors``;
arguments that are no JSON object, or repeat a name, are an error and stay
in the record as a string; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, maybe_broadcast

# Types of a schema and the VARIANT types that satisfy them (fixed values).
TYPES = {"string": "STRING", "integer": "BIGINT|DOUBLE|DECIMAL.*|FLOAT", "number": "BIGINT|DOUBLE|DECIMAL.*|FLOAT",
         "boolean": "BOOLEAN", "array": "ARRAY.*", "object": "OBJECT.*"}


#: Digits up to which a number is written out.
PLAIN = 40


def canonical_number(token: Column) -> Column:
    """The one text of a JSON number's value."""
    mantissa = F.regexp_extract(token, r"^-?([0-9.]+)", 1)
    exponent = F.coalesce(F.regexp_extract(token, r"[eE]([+-]?[0-9]+)$", 1).try_cast("int"), F.lit(0))
    whole = F.substring_index(mantissa, ".", 1)
    digits = F.replace(mantissa, F.lit("."), F.lit(""))
    led = F.ltrim(digits, F.lit("0"))
    # the point stands behind so many of the digits
    point = F.length(whole) + exponent - (F.length(digits) - F.length(led))
    kept = F.rtrim(led, F.lit("0"))
    plain = F.when(point <= 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), kept)).when(
        point >= F.length(kept), F.rpad(kept, point, "0")).otherwise(
        F.concat(F.substring(kept, F.lit(1), point), F.lit("."), F.substring(kept, point + 1, F.length(kept))))
    long = F.concat(F.substring(kept, 1, 1), F.when(F.length(kept) > 1, F.concat(
        F.lit("."), F.substring(kept, F.lit(2), F.length(kept)))).otherwise(F.lit("")),
        F.when(point > 0, F.lit("e+")).otherwise(F.lit("e-")), F.abs(point - 1).cast("string"))
    text = F.when((point > PLAIN) | (point < -PLAIN), long).otherwise(plain)
    return F.when(kept == "", F.lit("0")).otherwise(
        F.concat(F.when(token.startswith("-"), F.lit("-")).otherwise(F.lit("")), text))


def canonical_json(text: Column) -> Column:
    """JSON without white space, its numbers in their one form.  Quotes and
    backslashes escaped within strings are set aside, so that every other
    piece between quotes is outside the strings."""
    aside = F.replace(F.replace(text, F.lit("\\\\"), F.lit("\x01")), F.lit('\\"'), F.lit("\x02"))
    pieces = F.transform(F.split(aside, '"'), lambda piece, i: F.when(
        (i % 2 == 0) & piece.rlike("[0-9]"), F.array_join(F.transform(
            F.regexp_extract_all(piece, F.lit("-?[0-9][0-9.eE+-]*|[^0-9-]+"), F.lit(0)),
            lambda t: F.when(t.rlike("[0-9]"), canonical_number(t)).otherwise(t)), "")).otherwise(piece))
    joined = F.array_join(pieces, '"')
    return F.replace(F.replace(joined, F.lit("\x02"), F.lit('\\"')), F.lit("\x01"), F.lit("\\\\"))


def json_text(value: Column) -> Column:
    """A string as a JSON string; null as null."""
    quoted = F.to_json(F.array(value))
    return F.when(value.isNull(), F.lit("null")).otherwise(
        F.substring(quoted, F.lit(2), F.length(quoted) - 2))


def _one(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The row of the earliest turn of each (conv_id, call_id); ties go to
    the smallest values."""
    return (rows.groupBy("conv_id", "call_id")
            .agg(F.min(F.struct("turn", *columns)).alias("first"),
                 (F.count(F.lit(1)) - 1).alias("repeats"))
            .select("conv_id", "call_id", "first.*", "repeats"))


def _later(rows: DataFrame, first: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame | None]:
    """``first`` with the equal rows alone as ``repeats``, and the other
    values of its identifiers, each at its earliest turn with its own
    ``repeats`` (None if there are none)."""
    many = first.where("repeats > 0").select(
        F.col("conv_id").alias("__c"), F.col("call_id").alias("__i"), F.struct(*columns).alias("__first"))
    if many.isEmpty():
        return first, None
    values = rows.groupBy("conv_id", "call_id", *columns).agg(
        F.min(F.struct("turn")).alias("at"), (F.count(F.lit(1)) - 1).alias("repeats"))
    values = cut_lineage(values.join(
        maybe_broadcast(many), values["conv_id"].eqNullSafe(many["__c"]) & (values["call_id"] == many["__i"])).select(
        "conv_id", "call_id", F.col("at.turn").alias("turn"), *columns, "repeats",
        F.struct(*columns).eqNullSafe(F.col("__first")).alias("equal")), "repeated-calls")
    equal = values.where("equal").select(F.col("conv_id").alias("__c"), F.col("call_id").alias("__i"),
                                         F.col("repeats").alias("__equal"))
    first = first.join(equal, first["conv_id"].eqNullSafe(equal["__c"]) & (first["call_id"] == equal["__i"]), "left")
    return (first.withColumn("repeats", F.coalesce("__equal", F.lit(0))).drop("__c", "__i", "__equal"),
            values.where("not equal").drop("equal"))


def _doubled(state: DataFrame) -> DataFrame:
    """``state`` (node, up, dist, top, ...): pointers followed to their ends;
    ``up`` stays set on and behind a cycle."""
    state = cut_lineage(state, "call-levels")
    longest = state.groupBy("node.conv_id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    kept = [c for c in state.columns if c not in ("up", "dist", "top")]
    for _ in range((longest or 1).bit_length()):
        if state.where("up is not null").isEmpty():
            break
        at = state.select(F.col("node").alias("__node"), F.col("up").alias("__up"), F.col("dist").alias("__dist"),
                          F.col("top").alias("__top"))
        state = cut_lineage(state.join(at, F.col("up") == F.col("__node"), "left").select(
            *kept, F.col("__up").alias("up"), (F.col("dist") + F.coalesce("__dist", F.lit(0))).alias("dist"),
            F.coalesce("__top", "top").alias("top")), "call-levels")
    return state


def levels(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, level, dangling) of calls with unique keys."""
    node = F.struct("conv_id", "call_id")
    several = dict(calls.dtypes)["after"] != "string"
    there = calls.select(node.alias("__node"))  # equality of structs holds for null conversations
    if not several:
        need = F.when(F.col("after").isNotNull(), F.struct("conv_id", F.col("after").alias("call_id")))
        state = calls.select(node.alias("node"), need.alias("need"))
        state = state.join(there, F.col("need") == F.col("__node"), "left").select(
            "node", F.col("__node").alias("up"), F.col("__node").isNotNull().cast("long").alias("dist"),
            F.coalesce("__node", "node").alias("top"),
            (F.col("need").isNotNull() & F.col("__node").isNull()).alias("dangling"))
        return _doubled(state).select("node.*", F.when(F.col("up").isNull(), F.col("dist"))
                                      .otherwise(F.lit(-1)).alias("level"), "dangling")

    wanted = calls.select(node.alias("node"), "conv_id", F.explode(F.array_distinct(F.array_compact("after"))).alias("id"))
    wanted = wanted.select("node", F.struct("conv_id", F.col("id").alias("call_id")).alias("need"))
    edges = cut_lineage(wanted.join(there, F.col("need") == F.col("__node"), "left").select(
        "node", "need", F.col("__node").isNotNull().alias("known")), "call-edges")
    held = edges.groupBy("node").agg(
        F.count_if("known").alias("n"), F.min(F.when(F.col("known"), F.col("need"))).alias("up"),
        F.bool_or(~F.col("known")).alias("dangling"))
    state = calls.select(node.alias("node")).join(held, "node", "left")
    one = F.coalesce("n", F.lit(0)) == 1
    state = _doubled(state.select(
        "node", F.coalesce("n", F.lit(0)).alias("n"), F.when(one, F.col("up")).alias("up"), one.cast("long").alias("dist"),
        F.when(one, F.col("up")).otherwise(F.col("node")).alias("top"), F.coalesce("dangling", F.lit(False)).alias("dangling")))
    # arcs between calls that need several, over contracted chains; those from a root carry a level at once
    needs = state.where("n > 1").select(F.col("node").alias("__node"))
    at = state.select(F.col("node").alias("need"), F.col("dist").alias("__dist"), F.col("top").alias("__top"),
                      F.col("up").isNotNull().alias("stuck"))
    many = edges.where("known").join(needs, F.col("node") == F.col("__node"), "left_semi").join(at, "need")
    arcs = many.select("node", F.col("__top").alias("top"), (F.col("__dist") + 1).alias("far"), "stuck").join(
        needs.select(F.col("__node").alias("top"), F.lit(True).alias("inner")), "top", "left")
    arcs = cut_lineage(arcs.select("node", "top", "far", (F.coalesce("inner", F.lit(False)) | F.col("stuck")).alias("open")),
                       "call-arcs")
    waiting = cut_lineage(arcs.groupBy("node").agg(
        F.count_if("open").alias("left"), F.max(F.when(~F.col("open"), F.col("far"))).alias("level")), "call-waiting")
    done = []
    while True:
        ready = waiting.where("left = 0").select("node", "level")
        if ready.isEmpty():
            break
        done.append(ready)
        reached = ready.select(F.col("node").alias("top"), F.col("level").alias("__level"))
        got = arcs.where("open").join(reached, "top").groupBy("node").agg(
            F.count(F.lit(1)).alias("got"), F.max(F.col("far") + F.col("__level")).alias("__level"))
        waiting = cut_lineage(waiting.where("left > 0").join(got, "node", "left").select(
            "node", (F.col("left") - F.coalesce("got", F.lit(0))).alias("left"),
            F.greatest("level", "__level").alias("level")), "call-waiting")
    levelled = state
    if done:
        known = reduce(DataFrame.unionByName, done).select(F.col("node").alias("top"), F.col("level").alias("of_top"))
        levelled = state.join(known, "top", "left")
    else:
        levelled = state.withColumn("of_top", F.lit(None).cast("long"))
    root = levelled.join(needs.select(F.col("__node").alias("top"), F.lit(True).alias("inner")), "top", "left")
    level = F.when(F.col("up").isNotNull(), F.lit(-1)).when(F.col("inner").isNull(), F.col("dist")).otherwise(
        F.coalesce(F.col("of_top") + F.col("dist"), F.lit(-1)))
    return root.select("node.*", level.cast("long").alias("level"), "dangling")


def _errors(schema: Column, args: Column) -> Column:
    """Errors of the arguments (a map of VARIANT, null when they did not
    parse) under a tool's schema (an array of its arguments)."""
    def fault(f):
        v = args[f["arg"]]
        kind = F.schema_of_variant(v)
        number = F.try_variant_get(v, "$", "double")
        wrong = F.lit(False)
        for name, pattern in TYPES.items():
            wrong = wrong | ((f["type"] == name) & ~F.coalesce(kind.rlike(f"^({pattern})$"), F.lit(False)))
        outside = F.coalesce((number < f["least"]) | (number > f["most"]), F.lit(False))
        there = F.array_contains(F.map_keys(args), f["arg"])
        # 1e2 and 100.0 are integers, 1e-3 and 1.5 are none
        broken = canonical_number(F.to_json(v)).rlike(r"e-|^[^e]*\.[^e]*$")
        wrong = wrong | ((f["type"] == "integer") & kind.rlike("^(DOUBLE|DECIMAL.*|FLOAT)$") & broken)
        return F.when(~there & f["required"], F.concat(F.lit("missing "), f["arg"])) \
            .when(there & wrong, F.concat(F.lit("type "), f["arg"])) \
            .when(there & outside, F.concat(F.lit("range "), f["arg"]))
    named = F.transform(schema, lambda f: f["arg"])
    unknown = F.transform(F.array_except(F.map_keys(args), named),
                          lambda a: F.concat(F.lit("unknown "), a))
    return F.concat(F.filter(F.transform(schema, fault), lambda e: e.isNotNull()), unknown)


def link(calls: DataFrame, results: DataFrame, schemas: DataFrame,
         later_rows: bool = False) -> DataFrame:
    """``calls``: conv_id, turn, call_id, tool, arguments, after (a string or an
    array of strings); ``results``:
    conv_id, turn, call_id, content; ``schemas``: tool, arg, type, required,
    least, most (a row per argument).

    One row per call, orphan result, unidentified row or (``later_rows``)
    other value of a repeated identifier: ``conv_id, turn,
    call_id, tool, status, level, errors`` (joined by ``;``), ``repeats`` and
    ``record``, the canonical JSON."""
    calls = calls.select("conv_id", "turn", "call_id", "tool", "arguments", "after")
    results = results.select("conv_id", "turn", "call_id", "content")
    one = cut_lineage(_one(calls.where("call_id is not null"), ["tool", "arguments", "after"]), "calls")
    answer = _one(results.where("call_id is not null"), ["content"])
    later = []
    if later_rows:
        answer = cut_lineage(answer, "results")
        one, other = _later(calls.where("call_id is not null"), one, ["tool", "arguments", "after"])
        answer, otherwise = _later(results.where("call_id is not null"), answer, ["content"])
        # a later call is in no level, but its arguments are checked
        if other is not None:
            later.append(other.drop("after").withColumn("dangling", F.lit(False)))
        if otherwise is not None:
            later.append(otherwise)
    answer = answer.select(
        F.col("conv_id").alias("__conv"), F.col("call_id").alias("__id"), F.col("turn").alias("__turn"),
        "content", F.col("repeats").alias("__repeats"), F.lit(True).alias("answered"))
    level = levels(one).select(F.col("conv_id").alias("__c"), F.col("call_id").alias("__i"), "level",
                               "dangling")
    one = one.join(level, one["conv_id"].eqNullSafe(level["__c"]) & (one["call_id"] == level["__i"])) \
        .drop("__c", "__i")
    linked = one.withColumn("called", F.lit(True)).join(
        answer, one["conv_id"].eqNullSafe(answer["__conv"]) & (one["call_id"] == answer["__id"]), "full")
    called = F.coalesce("called", F.lit(False))
    linked = linked.select(
        F.when(called, F.col("conv_id")).otherwise(F.col("__conv")).alias("conv_id"),
        F.coalesce("call_id", "__id").alias("call_id"),
        F.when(called, F.col("turn")).otherwise(F.col("__turn")).alias("turn"),
        "tool", "arguments", "level", "dangling", "content",
        (F.coalesce("repeats", F.lit(0)) + F.coalesce("__repeats", F.lit(0))).alias("repeats"),
        F.when(~called, "orphan").when(F.col("answered"), "linked").otherwise("unanswered").alias("status"))
    nothing = [F.lit(None).cast("string").alias(c) for c in ("tool", "arguments")]
    lost = calls.where("call_id is null").select("conv_id", "turn", "tool", "arguments",
                                                 F.lit(None).cast("string").alias("content")).unionByName(
        results.where("call_id is null").select("conv_id", "turn", *nothing, "content"))
    linked = linked.unionByName(lost.withColumn("status", F.lit("unidentified"))
                                .withColumn("repeats", F.lit(0).cast("long")), allowMissingColumns=True)
    for rows in later:
        linked = linked.unionByName(rows.withColumn("status", F.lit("repeated")), allowMissingColumns=True)

    tools = schemas.where("tool is not null and arg is not null").groupBy(F.col("tool").alias("__tool")).agg(
        F.sort_array(F.collect_list(F.struct("arg", "type", "required", "least", "most"))).alias("schema"))
    checked = linked.join(maybe_broadcast(tools), linked["tool"] == F.col("__tool"), "left")
    parsed = F.try_parse_json("arguments")
    is_object = F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT"), F.lit(False))
    checked = checked.withColumn("__ok", is_object)
    args = F.when(F.col("__ok"), parsed.cast("map<string,variant>"))
    is_call = F.col("status").isin("linked", "unanswered") | (
        (F.col("status") == "repeated") & F.col("dangling").isNotNull())
    errors = F.concat(
        F.when(is_call & F.coalesce("dangling", F.lit(False)), F.array(F.lit("after unknown")))
        .otherwise(F.array().cast("array<string>")),
        F.when(is_call & (F.col("level") == -1), F.array(F.lit("cycle")))
        .otherwise(F.array().cast("array<string>")),
        F.when(~is_call, F.array().cast("array<string>"))
        .when(F.col("__tool").isNull(), F.array(F.lit("unknown tool")))
        .when(~F.col("__ok"), F.array(F.lit("bad arguments")))
        .otherwise(_errors(F.col("schema"), args)))
    record = F.concat(
        F.lit('{"arguments":'), F.when(F.col("__ok"), canonical_json(F.to_json(parsed))).otherwise(json_text(F.col("arguments"))),
        F.lit(',"call_id":'), json_text(F.col("call_id")),
        F.lit(',"level":'), F.coalesce(F.col("level").cast("string"), F.lit("null")),
        F.lit(',"result":'), json_text(F.col("content")),
        F.lit(',"tool":'), json_text(F.col("tool")), F.lit("}"))
    return checked.select("conv_id", "turn", "call_id", "tool", "status", "level",
                          F.array_join(errors, ";").alias("errors"), "repeats", record.alias("record"))
