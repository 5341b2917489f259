"""Ordered literal replacement and sentence trimming for localized text."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

from litsieve.functions.text import as_column, bind, squeeze, strip_ends, strip_long, text_or_empty

Pairs = Sequence[tuple[str, str]]
Rules = Sequence[tuple[str, str, str]]

# Repairs for replacements that fire on their own output, in
# order, as (literal the pattern starts with, pattern, replacement).
COLLAPSE_RULES = (
    ("基准测试", "(基准测试)(?:基准测试|测试)+", "$1"),
    ("工作流程", "(工作流程)(?:工作流程|流程)+", "$1"),
    ("单细胞", "(单细胞)(?:单细胞)+", "$1"),
    ("流程程", "流程程+", "流程"),
    ("测试测", "测试测试+", "测试"),
)


def _usable(pairs: Pairs) -> list[tuple[str, str]]:
    return [(source, target) for source, target in pairs if source and target]


def _collapse(text: Column, rules: Rules) -> Column:
    def repair(out: Column, rule: tuple[str, str, str]) -> Column:
        head, pattern, target = rule
        return bind(out, lambda t: F.when(t.contains(head), F.regexp_replace(t, pattern, target)).otherwise(t))

    return squeeze(reduce(repair, rules, text))


def _entries(usable: Pairs) -> Column:
    return F.array(*(F.struct(F.lit(s).alias("source"), F.lit(t).alias("target")) for s, t in usable))


def _replaced(text: Column, pair: Column) -> Column:
    # Looking for a source is several times cheaper than replacing one that is not there.
    found = text.contains(pair["source"])
    return F.when(found, F.replace(text, pair["source"], pair["target"])).otherwise(text)


def apply_glossary(text: Column | str, pairs: Pairs, rules: Rules = COLLAPSE_RULES) -> Column:
    """Replace each source by its target, in order; later pairs see earlier output."""
    start = bind(text_or_empty(text), strip_long)
    usable = _usable(pairs)
    if not usable:
        return _collapse(start, rules)
    return _collapse(F.aggregate(_entries(usable), start, lambda t, pair: _replaced(t, pair)), rules)


def trace_glossary(text: Column | str, pairs: Pairs, rules: Rules = COLLAPSE_RULES) -> Column:
    """Struct of the rewritten ``text`` and the ``changes`` that fired, in order."""
    start = strip_ends(text_or_empty(text))
    usable = _usable(pairs)
    empty = F.array().cast("array<struct<source:string,target:string>>")
    if not usable:
        return F.struct(_collapse(start, rules).alias("text"), empty.alias("changes"))

    def step(state: Column, pair: Column) -> Column:
        fires = state["text"].contains(pair["source"])
        return F.struct(
            _replaced(state["text"], pair).alias("text"),
            F.when(fires, F.concat(state["changes"], F.array(pair)))
            .otherwise(state["changes"])
            .alias("changes"),
        )

    return F.aggregate(
        _entries(usable),
        F.struct(start.alias("text"), empty.alias("changes")),
        step,
        lambda state: F.struct(
            _collapse(state["text"], rules).alias("text"), state["changes"].alias("changes")
        ),
    )


STOP = "。"


def _one_stop(text: Column, others: str) -> Column:
    """``text`` with every other stop as ``STOP``, so that literal searches do; a pattern costs several times more."""

    def unify(out: Column, other: str) -> Column:
        return bind(out, lambda t: F.when(t.contains(other), F.replace(t, F.lit(other), F.lit(STOP))).otherwise(t))

    return reduce(unify, others, text)


def _sentences(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, STOP), strip_long), lambda s: s != "")


def leading_sentences(text: Column | str, count: int = 2) -> Column:
    """First sentences of a translated abstract, each closed by a full stop; may be ``''``."""
    body = bind(
        _one_stop(text_or_empty(text), "！!?"),
        # Text without a stop is one sentence as it stands.
        lambda t: F.when(t.contains(STOP), F.array_join(F.slice(_sentences(t), 1, count), STOP)).otherwise(strip_long(t)),
    )
    return bind(body, lambda b: F.when(b == "", F.lit("")).otherwise(F.concat(b, F.lit(STOP))))


def cap_sentences(text: Column | str, limit: int) -> Column:
    """Cut a summary after ``limit`` sentences; shorter ones stay as they are.

    An ASCII exclamation mark does not end a sentence here.
    """

    def cut(stopped: Column, whole: Column) -> Column:
        kept = bind(
            _sentences(stopped),
            lambda parts: F.when(
                F.size(parts) > limit, F.concat(F.array_join(F.slice(parts, 1, limit), STOP), F.lit(STOP))
            ).otherwise(whole),
        )
        # More than ``limit`` sentences have at least as many stops between them.
        return F.when(F.substring_index(stopped, STOP, limit) == stopped, whole).otherwise(kept)

    return bind(as_column(text), lambda whole: bind(_one_stop(whole, "！?"), lambda stopped: cut(stopped, whole)))


def fill_template(template: str, **columns: Column | str) -> Column:
    """Fill ``{name}`` slots of a template from columns."""
    pieces: list[Column] = []
    rest = template
    while rest:
        head, brace, tail = rest.partition("{")
        if head:
            pieces.append(F.lit(head))
        if not brace:
            break
        name, _, rest = tail.partition("}")
        pieces.append(text_or_empty(columns[name]))
    return F.concat(*pieces) if pieces else F.lit("")
