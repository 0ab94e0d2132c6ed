"""Finding the phrases of a large list, such as names or places, by a join.

A recognizer's word list becomes one regular expression, which suits hundreds of words.  A list of
hundreds of thousands is a table instead: texts are cut into pieces (words, and each other character
by itself), runs of as many pieces as some phrase has become rows, and an equi-join with the list
keeps those that are a phrase.  The cost of a text does not depend on how long the list is.

A run equals a phrase if both have the same pieces, whatever the case, with white space between the
same ones, however much.  So a phrase never starts or ends inside of a word.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cloakframe.functions.hof import let, running, sums_before
from cloakframe.operators.detect import quoted, text_columns

WORD = r"\p{L}\p{M}\p{N}_"
SPACE = r"\s\x0B\p{Z}"
#: A piece with the white space before it.
PIECE = rf"[{SPACE}]*([{WORD}]+|[^{WORD}{SPACE}])"

#: A list of at most this many phrases and characters goes to every task; a larger one is shuffled with the runs.
BROADCAST_PHRASES, BROADCAST_CHARS = 1 << 20, 32 << 20
#: The entity type and score of a list that names none.
DEFAULT_TYPE, DEFAULT_SCORE = "PHRASE", 0.85


def pieces(text: Column, bare: bool = False) -> Column:
    """The pieces with the white space before each, or ``bare`` of it."""
    return F.regexp_extract_all(text, F.lit(PIECE), F.lit(1 if bare else 0))


def canonical(run: Column) -> Column:
    """What equal phrases have in common: lower case, one blank for any white space inside."""
    return F.lower(F.trim(F.regexp_replace(run, f"[{SPACE}]+", " ")))


def phrase_list(phrases: DataFrame) -> DataFrame:
    """``phrases`` (phrase, and perhaps entity_type and score) as (form, entity_type, score, n).

    One row per form and type, with the highest score; null and blank phrases are left out.
    """
    text = F.col("phrase").cast("string")
    kind = F.col("entity_type").cast("string") if "entity_type" in phrases.columns else F.lit(None).cast("string")
    score = F.col("score").cast("double") if "score" in phrases.columns else F.lit(None).cast("double")
    rows = phrases.select(
        canonical(text).alias("form"),
        F.coalesce(kind, F.lit(DEFAULT_TYPE)).alias("entity_type"),
        F.coalesce(score, F.lit(DEFAULT_SCORE)).alias("score"),
        F.size(pieces(text)).alias("n"),
    )
    return rows.where("n > 0").groupBy("form", "entity_type").agg(F.max("score").alias("score"), F.min("n").alias("n"))


def _places(text: Column, longest: int) -> Column:
    """For each piece: the characters before it, and it and its followers, as they stand and as in forms.

    Followers beyond the end are null.  What depends on how many pieces a run has is left to plain columns.
    """

    def ahead(all_: Column, k: int) -> Column:
        return F.slice(all_, k + 1, F.greatest(F.size(all_) - k, F.lit(0))) if k else all_

    def zipped(cut: Column) -> Column:
        forms = F.zip_with(cut, pieces(text, bare=True), lambda c, b: F.when(F.length(c) > F.length(b), F.concat(F.lit(" "), F.lower(b))).otherwise(F.lower(b)))
        before = let(F.transform(cut, lambda c: F.length(c)), lambda sizes: sums_before(sizes))
        return let(forms, lambda f: F.arrays_zip(before.alias("before"), *[ahead(x, k) for k in range(longest) for x in (cut, f)]))

    names = ["before", *(f"{x}{k}" for k in range(longest) for x in "cf")]
    kind = ",".join(f"{n}:{'int' if n == 'before' else 'string'}" for n in names)
    return let(pieces(text), zipped).cast(f"array<struct<{kind}>>")


def heads(listed: DataFrame, least: int) -> DataFrame:
    """head: the first ``least`` pieces of every form."""
    return listed.select(F.array_join(F.slice(pieces(F.col("form")), 1, least), "").alias("head")).distinct()


def runs(df: DataFrame, keys: Sequence[str], names: Sequence[str], lengths: Sequence[int], starts: DataFrame | None = None) -> DataFrame:
    """All runs of ``lengths`` pieces: _cell (a number of its cell), the keys, column_name, form, raw, before.

    ``raw`` is the run with the white space before it, ``before`` counts the characters before that.  With
    ``starts``, the ``heads`` of a list, only places at which the shortest run is one of them.
    """
    kept = [quoted(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    labelled = F.array(*[F.struct(F.lit(n).alias("column_name"), quoted(n).cast("string").alias("text")) for n in names])
    cells = df.select(*kept, F.explode(labelled).alias("_c")).where("_c.text is not null")
    own = [f"_k{i}" for i in range(len(keys))]
    # made inside of one expression, so that no row carries the pieces of its whole text
    found = F.when(F.col("_c.text").rlike(f"[^{SPACE}]"), _places(F.col("_c.text"), max(lengths)))
    each = cells.select(*own, F.monotonically_increasing_id().alias("_cell"), F.col("_c.column_name").alias("column_name"), found.alias("_p"))
    placed = each.select(*own, "_cell", "column_name", F.inline("_p"))
    if starts is not None:
        shortest = F.ltrim(F.concat(*[F.col(f"f{k}") for k in range(min(lengths))]))
        placed = placed.join(F.broadcast(starts), shortest == F.col("head"), "left_semi")
    sized = F.array(*[F.struct(*[F.concat(*[F.col(f"{x}{k}") for k in range(n)]).alias(a) for x, a in (("f", "form"), ("c", "raw"))]) for n in lengths])
    some = placed.select(*own, "_cell", "column_name", "before", F.explode(sized).alias("_r")).where("_r.form is not null")
    return some.select(*own, "_cell", "column_name", "before", F.ltrim("_r.form").alias("form"), F.col("_r.raw").alias("raw"))


def _leftmost_longest(spans: Column) -> Column:
    """Of spans sorted by start, the longest first: each that starts where the one kept before has ended."""
    seed = F.struct(F.lit(0).alias("end"), F.lit(True).alias("kept"))

    def step(prev: Column, i: Column) -> Column:
        s = F.get(spans, i)
        fits = s.start >= prev.end
        return F.struct(F.when(fits, -s.back).otherwise(prev.end).alias("end"), fits.alias("kept"))

    flags = running(F.size(spans), seed, step)
    return F.filter(F.zip_with(spans, flags, lambda s, f: F.when(f.kept, s)), lambda s: s.isNotNull())


def find_phrases(df: DataFrame, key: str | Sequence[str], phrases: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per phrase found: the key, column_name, entity_type, text, start, end, score, ord, like ``detect``.

    Of phrases of one type that overlap in a cell the leftmost counts, and of those that start together the
    longest; types do not hinder one another.  ``ord`` counts a cell's findings by place, then by type.  Null and
    empty cells and lists hold nothing; repeated rows are found each for itself.
    """
    keys = [key] if isinstance(key, str) else list(key)
    names = text_columns(df, columns)
    listed = phrase_list(phrases)
    size = listed.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.length("form")).alias("chars"), F.sort_array(F.collect_set("n")).alias("lengths")).first()
    wanted = listed.select("form", "entity_type", "score")
    starts = None
    if size.rows <= BROADCAST_PHRASES and (size.chars or 0) <= BROADCAST_CHARS:
        wanted = F.broadcast(wanted)
        starts = heads(listed, min(size.lengths, default=1))
    types = {f.name: f.dataType for f in df.schema}
    if not names or not size.rows:
        none = df.limit(0).select(*[quoted(k) for k in keys])
        return none.select(*[quoted(k) for k in keys], *[F.lit(None).cast(t).alias(c) for c, t in _FOUND])
    own = [f"_k{i}" for i in range(len(keys))]
    found = runs(df, keys, names, size.lengths, starts).join(wanted, "form")
    found = found.withColumn("text", F.regexp_replace("raw", f"^[{SPACE}]+", "")).withColumn("end", F.col("before") + F.length("raw"))
    found = found.withColumn("start", F.col("end") - F.length("text"))
    span = F.struct(F.col("start"), (-F.col("end")).alias("back"), F.col("text"), F.col("score"))
    cells = found.groupBy("_cell", "column_name", "entity_type").agg(F.sort_array(F.collect_list(span)).alias("_s"), *[F.first(k).alias(k) for k in own])
    typed = cells.select("_cell", "column_name", *own, "entity_type", let(F.col("_s"), _leftmost_longest).alias("_s"))
    whole = typed.groupBy("_cell", "column_name").agg(
        F.sort_array(F.flatten(F.collect_list(F.transform("_s", lambda s: F.struct(s.start.alias("start"), F.col("entity_type").alias("entity_type"), (-s.back).alias("end"), s.text.alias("text"), s.score.alias("score")))))).alias("_s"),
        *[F.first(k).alias(k) for k in own],
    )
    out = whole.select(*own, "column_name", F.posexplode("_s").alias("ord", "_f"))
    return out.select(
        *[F.col(o).cast(types[k]).alias(k) for o, k in zip(own, keys)],
        "column_name", "_f.entity_type", "_f.text", F.col("_f.start").cast("int").alias("start"), F.col("_f.end").cast("int").alias("end"), "_f.score", "ord",
    )


_FOUND = [("column_name", "string"), ("entity_type", "string"), ("text", "string"), ("start", "int"), ("end", "int"), ("score", "double"), ("ord", "int")]
