"""Personal data by bootstrapped contextual extraction, in built-in functions throughout.

Four kinds have a base pattern; what it finds is the seed set.  The words around a seed (two before
it; one before and one after) are a lexical pattern of its kind.  Other tokens with a digit or an at
sign are candidates, and stand in contexts as well.  Patterns and instances form a graph, scored in
turns: a pattern is worth the mean score of its instances, an instance as much as its patterns
together (noisy or); seeds stay at one for their kind.  Patterns of high worth, with enough different
seeds, make spans of the candidates in their place that have their kind's shape.

Texts are read once.  The graph holds one row per distinct (pattern, instance), counted before the
shuffle, so a context that a third of all texts share is no large group.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cloakframe.functions.hof import let, running
from cloakframe.llm.stage import saved

# Kinds in their order and what matches them.  Each pattern finds what the plain one
# named behind it finds, from left to right without overlap, but never begins again inside a run.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"  # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"  # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])"  # [0-9]([\x20-]?[0-9])+ with 16 to 19 digits
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")
#: A token with a digit or an at sign.
CANDIDATE = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
#: What a candidate must look like to become a span of each kind.
SHAPES = {
    "email": r"^[^@\s]+@[^@\s]+\.[^@\s]+$",
    "ip": r"^[0-9]+(?:[.:][0-9]+){3}$",
    "card": r"^[0-9](?:-?[0-9]){12,18}$",
    "phone": r"^\(?[0-9](?:[().-]?[0-9]){7,14}$",
}

#: Characters around an instance in which context words are looked for.
CONTEXT = 80
#: Turns of the scoring; the least worth and number of different seeds of a pattern that makes spans.
TURNS, WORTH, SEEDS = 3, 0.9, 10

_FOUND = "array<struct<start:int,end:int,value:string,before:string,after:string>>"


def _matches(text: Column, pattern: str) -> Column:
    """Every match with its place in code points and what stands around it, cut between words."""

    def placed(parts: Column) -> Column:
        values, gaps = parts["values"], parts["gaps"]

        def step(last: Column, i: Column) -> Column:
            start = last["end"] + F.length(F.get(gaps, i))
            return F.struct(start.alias("start"), (start + F.length(F.get(values, i))).alias("end"))

        def row(place: Column, i: Column) -> Column:
            before, after = F.get(gaps, i), F.get(gaps, i + 1)
            before = F.when(F.length(before) > CONTEXT, F.regexp_replace(F.right(before, F.lit(CONTEXT)), r"^\S+", "")).otherwise(before)
            after = F.when(F.length(after) > CONTEXT, F.regexp_replace(F.left(after, F.lit(CONTEXT)), r"\S+$", "")).otherwise(after)
            return F.struct(place["start"].alias("start"), place["end"].alias("end"), F.get(values, i).alias("value"), before.alias("before"), after.alias("after"))

        places = running(F.size(values), F.struct(F.lit(0).alias("start"), F.lit(0).alias("end")), step)
        return let(places, lambda found: F.transform(found, row))

    parts = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("values"), F.split(text, pattern, -1).alias("gaps"))
    return F.when(text.rlike(pattern), let(parts, placed)).otherwise(F.array().cast(_FOUND))


def _apart(tokens: Column, base: Column) -> Column:
    """The tokens, disjoint and in order, that overlap no base span: one pass over all ends of tokens and starts of spans."""

    def swept(events: Column) -> Column:
        def step(last: Column, k: Column) -> Column:
            e = F.get(events, k)
            span = e["token"] < 0
            reach = F.when(span, F.greatest(last["reach"], e["other"])).otherwise(last["reach"])
            return F.struct(reach.alias("reach"), F.when(~span & (last["reach"] <= e["other"]), e["token"]).otherwise(F.lit(-1)).alias("token"))

        kept = running(F.size(events), F.struct(F.lit(-1).alias("reach"), F.lit(-1).alias("token")), step)
        return F.transform(F.filter(kept, lambda r: r["token"] >= 0), lambda r: F.get(tokens, r["token"]))

    # a span that starts where a token ends does not overlap it and comes after it
    ends = F.transform(tokens, lambda t, i: F.struct(t["end"].alias("at"), F.lit(0).alias("order"), t["start"].alias("other"), i.alias("token")))
    starts = F.transform(base, lambda b: F.struct(b["start"].alias("at"), F.lit(1).alias("order"), b["end"].alias("other"), F.lit(-1).alias("token")))
    return F.when((F.size(tokens) > 0) & (F.size(base) > 0), let(F.array_sort(F.concat(ends, starts)), swept)).otherwise(tokens)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _base(text: Column) -> dict[str, Column]:
    part = r"^0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})$"
    return {
        "email": F.when(F.contains(text, F.lit("@")), _matches(text, EMAIL)).otherwise(F.array().cast(_FOUND)),
        "ip": F.filter(_matches(text, IP), lambda m: F.forall(F.split(m["value"], r"\."), lambda x: x.rlike(part))),
        "card": F.filter(_matches(text, CARD), lambda m: F.call_function("luhn_check", _digits(m["value"]))),
        "phone": F.when(F.contains(text, F.lit("+")), F.filter(_matches(text, PHONE), lambda m: F.length(_digits(m["value"])).between(8, 15))).otherwise(F.array().cast(_FOUND)),
    }


def _contexts(m: Column) -> Column:
    """The lexical patterns around an instance: two words before it; one before and one after."""
    before, after = F.lower(m["before"]), F.lower(m["after"])
    two = F.regexp_extract(before, r"(\S+\s+\S+)\s*$", 1)
    one, next_ = F.regexp_extract(before, r"(\S+)\s*$", 1), F.regexp_extract(after, r"^\S?\s+(\S+)", 1)
    return F.array(F.when(two != "", F.concat(F.lit("2:"), F.regexp_replace(two, r"\s+", " "))), F.when((one != "") & (next_ != ""), F.concat(F.lit("1:"), one, F.lit(" _ "), next_)))


def _scored(seeds: DataFrame, candidates: DataFrame) -> DataFrame:
    """pattern, kind: the patterns worth making spans from; both inputs hold (pattern, value), seeds a kind too."""
    seeds, candidates = saved(seeds.distinct()), saved(candidates.distinct())
    size = seeds.select("pattern", "value").union(candidates.select("pattern", "value")).groupBy("pattern").agg(F.count(F.lit(1)).alias("size"))
    own = seeds.groupBy("pattern", "kind").agg(F.count(F.lit(1)).alias("seeds")).join(size, "pattern")
    own = saved(own)
    worth = own.withColumn("worth", F.col("seeds") / F.col("size"))
    shared = candidates.join(own.select("pattern", "kind"), "pattern")
    for _ in range(TURNS):
        instances = shared.join(worth.select("pattern", "kind", "worth"), ["pattern", "kind"]).groupBy("value", "kind").agg((1 - F.exp(F.sum(F.log1p(-F.least("worth", F.lit(1 - 1e-9)))))).alias("score"))
        gained = shared.join(instances, ["value", "kind"]).groupBy("pattern", "kind").agg(F.sum("score").alias("gained"))
        worth = saved(own.join(gained, ["pattern", "kind"], "left").withColumn("worth", (F.col("seeds") + F.coalesce("gained", F.lit(0.0))) / F.col("size")))
    # the mean with a share of the seeds that does not grow from its own gains alone
    return worth.where((F.col("worth") >= WORTH) & (F.col("seeds") >= SEEDS) & (2 * F.col("seeds") >= F.col("size"))).select("pattern", "kind")


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_private(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, base, added: arrays of (kind from 1, start, end), in order of kind and start, per row of ``docs``.

    Starts and ends are code points, ends exclusive.  Base spans do not overlap within a kind;
    added spans overlap no base span.  Null and empty texts have none.  Each row gets its own
    result, repeated ones and those of null key too.
    """
    own = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    base = _base(F.col("text"))

    def row(kind: int):
        return lambda m: F.struct(F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end"), m["value"].alias("value"), _contexts(m).alias("patterns"))

    found = own.select("doc_id", F.monotonically_increasing_id().alias("row"), F.concat(*(F.transform(base[name], row(k)) for k, name in enumerate(KINDS, 1))).alias("base"), _matches(F.col("text"), CANDIDATE).alias("tokens"))
    trimmed = F.transform("tokens", lambda m: F.struct(m["start"].alias("start"), (m["start"] + F.length(F.rtrim(m["value"], F.lit(".,;:!?)")))).alias("end"), F.rtrim(m["value"], F.lit(".,;:!?)")).alias("value"), _contexts(m).alias("patterns")))
    found = saved(found.withColumn("tokens", trimmed).withColumn("tokens", _apart(F.col("tokens"), F.col("base"))))

    seeds = found.select(F.explode("base").alias("b")).select("b.kind", "b.value", F.explode("b.patterns").alias("pattern")).where("pattern is not null")
    places = found.select("row", F.explode("tokens").alias("t")).select("row", "t.start", "t.end", "t.value", F.explode("t.patterns").alias("pattern")).where("pattern is not null")
    good = _scored(seeds, places.select("pattern", "value"))
    shape = reduce(lambda c, x: c.when(F.col("kind") == x[0], F.col("value").rlike(SHAPES[x[1]])), list(enumerate(KINDS, 1))[1:], F.when(F.col("kind") == 1, F.col("value").rlike(SHAPES[KINDS[0]])))
    # one token may be found by several patterns: its least kind counts
    added = places.join(good, "pattern").where(shape).groupBy("row", "start", "end").agg(F.min("kind").alias("kind")).groupBy("row").agg(F.sort_array(F.collect_list(F.struct("kind", "start", "end"))).alias("added"))
    spans = F.transform("base", lambda b: F.struct(b["kind"].alias("kind"), b["start"].alias("start"), b["end"].alias("end")))
    return found.select("doc_id", "row", spans.alias("base")).join(added, "row", "left").select("doc_id", "base", F.coalesce("added", F.array().cast("array<struct<kind:int,start:int,end:int>>")).alias("added"))


def span_digest(found: DataFrame) -> DataFrame:
    """The counts and digests of ``find_private``'s result: n_email, n_ip, n_card, n_phone of base spans,
    ``base_sha256``, ``spans`` (all spans as kind:start:end) and ``n_added``."""


    def of(kind: int):
        return lambda s: s["kind"] == kind

    counts = [F.size(F.filter("base", of(k))).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS, 1)]
    every = F.array_sort(F.concat("base", "added"))
    return found.select("doc_id", *counts, F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"), _joined(every).alias("spans"), F.size("added").cast("long").alias("n_added"))
