"""Finding spans in one text, entirely inside the JVM.

A match is located by wrapping every hit of a pattern in a separator and
splitting on it: odd pieces are the matches, and the lengths of all pieces
before one give its offset.  Offsets count code points, ``[start, end)``.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from cloakframe.functions.hof import let, running
from cloakframe.functions.recognizers import Gate, Pattern, Recognizer

SEP = "\u0001"
STAND_IN = "\u0002"  # same class for every pattern: neither word, space nor digit

CONTEXT_WORDS = 5
CONTEXT_BOOST = 0.35
CONTEXT_FLOOR = 0.4

SPAN_TYPE = (
    "array<struct<entity_type:string,text:string,start:int,end:int,score:double,ord:int>>"
)
MODEL_SPAN_TYPE = "array<struct<entity_type:string,start:int,end:int,score:double>>"

_HIT_TYPE = "array<struct<entity_type:string,score:double,parts:array<string>>>"
_RAW_TYPE = "array<struct<entity_type:string,text:string,start:int,end:int,score:double,before:string>>"


# Matches from which on it pays to look first whether a text has a context word at all.
DENSE = 64

# Spans up to which comparing each with all before it is cheaper than one ordered pass.
FEW = 8


def _plain(words: Sequence[str]) -> str | None:
    """A test that any text must pass that holds one of the words; none if they are more than plain words."""
    if not words:
        return "(?!)"
    return "|".join(words) if all(re.fullmatch("[A-Za-z0-9_ ]+", w) for w in words) else None


def _hits(text: Column, recognizers: Sequence[Recognizer]) -> Column:
    """One struct per pattern that occurs in the text, with the split pieces; nothing is built for the others."""

    def hit(r: Recognizer, pattern: Pattern) -> Column:
        marked = F.regexp_replace(text, pattern.java, f"{SEP}$0{SEP}")
        found = F.struct(
            F.lit(r.entity_type).alias("entity_type"),
            F.lit(pattern.score).alias("score"),
            F.split(marked, SEP).alias("parts"),
        )
        return F.when(text.rlike(pattern.java), found)

    behind: dict[Gate | None, list[Column]] = {}
    children: dict[Gate | None, list[Gate]] = {}
    for r in recognizers:
        for p in r.patterns:
            behind.setdefault(p.gate, []).append(hit(r, p))
    for gate in list(behind):
        while gate is not None:
            known = children.setdefault(gate.parent, [])
            if gate not in known:
                known.append(gate)
            gate = gate.parent

    none = F.array().cast(_HIT_TYPE)

    def collect(gate: Gate | None) -> Column:
        found = [F.when(g.test(text), collect(g)).otherwise(none) for g in children.get(gate, [])]
        if gate in behind:
            found.append(F.array_compact(F.array(*behind[gate])))
        return F.concat(*found) if len(found) > 1 else found[0]

    return collect(None) if recognizers else none


def _locate(hit: Column, original: Column, recognizers: Sequence[Recognizer]) -> Column:
    """All matches of one pattern with offsets and the words before each.

    Without blanks the words before a match grow with the text.  So where matches are many, they are
    gathered only if a context word of the type stands somewhere in the text.  A single match, as in
    most cells, needs no fold.
    """
    blanks = r"(?U)\s+"
    many = F.size(hit.parts) > 2 * DENSE
    plain = {r.entity_type: F.lit(_plain(r.context)).cast("string") for r in recognizers}
    context = _case_by_type(hit.entity_type, plain, F.lit(None).cast("string"))
    nowhere = many & ~F.rlike(F.lower(F.regexp_replace(original, blanks, " ")), context)
    folded = let(~F.coalesce(nowhere, F.lit(False)), lambda gather: _located(hit, original, gather))
    return F.when(F.size(hit.parts) == 3, _matches(F.array(_match(hit, _nothing(), F.lit(0), F.lit(True))), hit, original)).otherwise(folded)


def _nothing() -> Column:
    """The state before the first match."""
    return F.struct(F.lit(0).alias("start"), F.lit("").alias("text"), F.lit("").alias("before"))


def _match(hit: Column, prev: Column, i: Column, gather: Column) -> Column:
    lead = F.get(hit.parts, i * 2)
    matched = F.get(hit.parts, i * 2 + 1)
    words = F.concat(prev.before, prev.text, lead)
    return F.struct(
        (prev.start + F.length(prev.text) + F.length(lead)).alias("start"),
        matched.alias("text"),
        # The last five words and whatever touches the match itself.
        F.when(
            gather,
            F.substring_index(F.regexp_replace(words, r"(?U)\s+", " "), " ", -(CONTEXT_WORDS + 1)),
        ).otherwise("").alias("before"),
    )


def _matches(found: Column, hit: Column, original: Column) -> Column:
    return F.transform(
        F.filter(found, lambda s: F.length(s.text) > 0),
        lambda s: F.struct(
            hit.entity_type.alias("entity_type"),
            # Exact even when the cell itself holds the separator.
            F.when(
                F.contains(original, F.lit(SEP)),
                F.substring(original, s.start + 1, F.length(s.text)),
            ).otherwise(s.text).alias("text"),
            s.start.alias("start"),
            (s.start + F.length(s.text)).cast("int").alias("end"),
            hit.score.alias("score"),
            s.before.alias("before"),
        ),
    )


def _located(hit: Column, original: Column, gather: Column) -> Column:
    count = F.floor(F.size(hit.parts) / F.lit(2)).cast("int")
    return _matches(running(count, _nothing(), lambda prev, i: _match(hit, prev, i, gather)), hit, original)


def _case_by_type(
    entity_type: Column, branches: dict[str, Column], otherwise: Column
) -> Column:
    case = None
    for name, value in branches.items():
        test = entity_type == F.lit(name)
        case = F.when(test, value) if case is None else case.when(test, value)
    return otherwise if case is None else case.otherwise(otherwise)


def _with_score(span: Column, score: Column) -> Column:
    return span.withField("score", score)


def drop_contained(
    spans: Column, group: Callable[[Column], Column], level: Callable[[Column], Column]
) -> Column:
    """Drop a span lying inside another one of its group with a level not higher.

    Works for "same type, score not lower" and for "already applied, earlier in
    the order" alike.  Sorted by start (longest first), every container comes
    before its content, so one pass with the furthest end per level decides.
    Only levels not beaten by a lower one are carried: a handful, whatever the
    number of spans.  A few spans are compared with all before them, which costs
    less than the pass.
    """

    def keyed(some: Column) -> Column:
        return F.transform(
            some,
            lambda s: F.struct(
                group(s).alias("grp"),
                s.start.alias("start"),
                (-s.end).alias("neg_end"),
                level(s).cast("double").alias("lvl"),
                s.entity_type.alias("entity_type"),
                s.alias("span"),
            ),
        )

    def scan(ordered: Column) -> Column:
        def step(prev: Column, i: Column) -> Column:
            return let(F.get(ordered, i), lambda x: _advance(prev, x))

        def _advance(prev: Column, x: Column) -> Column:
            same = prev.grp == x.grp
            end = -x.neg_end
            inside = same & F.exists(
                prev.front, lambda f: (f.lvl <= x.lvl) & (f.end >= end)
            )
            mine = F.array(F.struct(x.lvl.alias("lvl"), end.alias("end")))
            others = F.filter(prev.front, lambda f: (f.lvl < x.lvl) | (f.end > end))
            return F.struct(
                x.grp.alias("grp"),
                inside.alias("inside"),
                F.when(inside, prev.front)
                .when(same, F.concat(others, mine))
                .otherwise(mine)
                .alias("front"),
            )

        seed = F.struct(
            F.lit("").alias("grp"),
            F.lit(False).alias("inside"),
            F.array().cast("array<struct<lvl:double,end:int>>").alias("front"),
        )
        return let(
            running(F.size(ordered), seed, step),
            lambda marks: F.transform(
                F.filter(
                    F.zip_with(ordered, marks, lambda x, m: F.struct(x.span.alias("span"), m.inside.alias("inside"))),
                    lambda z: ~z.inside,
                ),
                lambda z: z.span,
            ),
        )

    def compare(ordered: Column) -> Column:
        def outside(x: Column, i: Column) -> Column:
            return ~F.exists(F.slice(ordered, F.lit(1), i), lambda y: (y.grp == x.grp) & (y.lvl <= x.lvl) & (y.neg_end <= x.neg_end))

        return F.transform(F.filter(ordered, outside), lambda x: x.span)

    return let(
        spans,
        lambda some: F.when(F.size(some) < 2, some).otherwise(
            let(F.sort_array(keyed(some)), lambda o: F.when(F.size(o) <= FEW, compare(o)).otherwise(scan(o)))
        ),
    )


def _score(raw: Column, recognizers: Sequence[Recognizer]) -> Column:
    """Validated score: 1.0 when the check holds, 0.0 (dropped) when it fails."""
    checks = {
        r.entity_type: F.when(r.validator(raw.text), F.lit(1.0)).otherwise(F.lit(0.0))
        for r in recognizers
        if r.validator is not None
    }
    return _case_by_type(raw.entity_type, checks, raw.score)


def _boosted(raw: Column, recognizers: Sequence[Recognizer]) -> Column:
    near = {
        r.entity_type: F.lower(raw.before).rlike("|".join(r.context))
        for r in recognizers
        if r.context
    }
    raised = F.least(F.lit(1.0), F.greatest(F.lit(CONTEXT_FLOOR), raw.score + F.lit(CONTEXT_BOOST)))
    return F.when(_case_by_type(raw.entity_type, near, F.lit(False)), raised).otherwise(raw.score)


def may_hold(text: Column, recognizers: Sequence[Recognizer], threshold: float) -> Column:
    """Whether ``find_spans`` can find anything of these types: a necessary condition that builds no spans.

    One of their patterns occurs; where neither its score nor a check reaches the threshold, a context
    word must occur as well.  Words that are more than plain text are not looked for.
    """

    def reached(r: Recognizer, pattern: Pattern) -> Column | None:
        occurs = text.rlike(pattern.java)
        if r.validator is not None or pattern.score >= threshold:
            return occurs
        words = _plain(r.context)
        if not r.context or max(CONTEXT_FLOOR, pattern.score + CONTEXT_BOOST) < threshold:
            return None
        return occurs if words is None else occurs & F.lower(F.regexp_replace(text, r"(?U)\s+", " ")).rlike(words)

    behind: dict[Gate | None, list[Column]] = {}
    for r in recognizers:
        for p in r.patterns:
            if (found := reached(r, p)) is not None:
                behind.setdefault(p.gate, []).append(found)
    some = F.lit(False)
    for gate, tests in behind.items():
        any_of = reduce(lambda a, b: a | b, tests)
        while gate is not None:
            any_of, gate = gate.test(text) & any_of, gate.parent
        some = some | any_of
    return some


def safe_text(text: Column) -> Column:
    """The text with its own separators replaced."""
    return F.when(F.contains(text, F.lit(SEP)), F.translate(text, SEP, STAND_IN)).otherwise(text)


def find_spans(
    text: Column,
    recognizers: Sequence[Recognizer],
    threshold: float,
    model_spans: Column | None = None,
) -> Column:
    """The findings of one text, best score first; empty for null or blank."""
    empty = F.array().cast(SPAN_TYPE)
    raw = let(
        safe_text(text),
        lambda t: F.flatten(F.transform(_hits(t, recognizers), lambda h: _locate(h, text, recognizers))),
    )
    raw = F.filter(
        F.transform(raw, lambda s: _with_score(s, _score(s, recognizers))), lambda s: s.score > 0
    )
    if model_spans is not None:
        from_model = F.transform(
            F.coalesce(model_spans, F.array().cast(MODEL_SPAN_TYPE)),
            lambda m: F.struct(
                m.entity_type.alias("entity_type"),
                F.substring(text, m.start + 1, m.end - m.start).alias("text"),
                m.start.alias("start"),
                m.end.alias("end"),
                m.score.alias("score"),
                F.lit("").alias("before"),
            ),
        )
        raw = F.concat(raw.cast(_RAW_TYPE), from_model.cast(_RAW_TYPE))

    def by_type(spans: Column) -> Column:
        return drop_contained(spans, lambda s: s.entity_type, lambda s: -s.score)

    once = by_type(raw)
    raised = F.transform(once, lambda s: _with_score(s, _boosted(s, recognizers)))
    kept = F.filter(by_type(raised), lambda s: s.score >= F.lit(threshold))
    ranked = F.sort_array(
        F.transform(
            kept,
            lambda s: F.struct(
                (-s.score).alias("neg_score"),
                s.start.alias("start"),
                (-s.end).alias("neg_end"),
                s.entity_type.alias("entity_type"),
                s.text.alias("text"),
            ),
        )
    )
    numbered = F.transform(
        ranked,
        lambda s, i: F.struct(
            s.entity_type.alias("entity_type"),
            s.text.alias("text"),
            s.start.alias("start"),
            (-s.neg_end).cast("int").alias("end"),
            (-s.neg_score).alias("score"),
            i.alias("ord"),
        ),
    )
    return F.when(text.rlike(r"(?U)\S"), numbered).otherwise(empty)
