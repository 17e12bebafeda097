"""Personal data by candidate generation and gradient boosting, in DataFrame functions only.

Strict generators give the spans that always count. Wide generators propose further,
overlapping candidates: disguised addresses, other separators, missing prefixes. All
candidates are described by a few small whole numbers about their format and their
context, so the corpus condenses to one count for each combination. Boosted trees
are fitted on these counts, with the strict spans as the truth, and go back into the
plan as an expression; a wide candidate is redacted where its calibrated score
passes the threshold of its kind.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxtally.session import cut_lineage

KINDS = ("email", "ip", "card", "phone")

# Strict patterns, written so that no run of characters is tried from more than its start: \G lets a match begin where
# the last one ended. Runs that cannot pass are left out where that does not move another match.
STRICT = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
WIDE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?(?:@|[(\[{] ?at ?[)\]}]) ?[A-Za-z0-9-]++(?: ?(?:\.|[(\[{] ?dot ?[)\]}]) ?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]{1,3}+(?: ?(?:\.|,|[(\[{](?:\.|dot)[)\]}]) ?[0-9]{1,3}+){3}+(?![0-9])",
    "card": r"(?<![0-9])[0-9]{4}(?:[ ._/-]{1,3}+[0-9]{4}){2}[ ._/-]{1,3}+[0-9]{2,7}(?![0-9])",
    "phone": r"(?<![0-9.])\(?[0-9]{2,4}\)?[ ./-]{1,2}+[0-9]{3}[ ./-][0-9]{4}(?![0-9])",
}
CUES = {
    "email": "(?i)mail|contact|write",
    "ip": r"(?i)\bip|host|server|address",
    "card": "(?i)card|visa|credit|master",
    "phone": "(?i)tel|phone|call|mobile|fax",
}
CONTEXT = 24  # characters seen on each side of a candidate
FEATURES = ("digits", "groups", "separators", "valid", "left_side", "right_side", "cue", "plus", "uniform")
TREES, RATE, PRECISION, SUPPORT = 30, 0.3, 0.98, 20


def _literal(pattern: str) -> str:
    return "r'" + pattern.replace("'", r"\x27") + "'"


def _placed(found: str, gaps: str, kind: int, strict: bool) -> str:
    """Structs of all matches with their places: ``gaps`` are the texts around the ``found`` ones."""
    step = f"""named_struct('at', acc.at + length(x.gap) + length(x.value), 'out', concat(acc.out, array(named_struct(
        'start', acc.at + length(x.gap), 'kind', {kind}, 'end', acc.at + length(x.gap) + length(x.value), 'strict', {str(strict).lower()},
        'value', x.value, 'before', right(x.gap, {CONTEXT}), 'after', left(x.next, {CONTEXT})))))"""
    none = "cast(array() as array<struct<start:int,kind:int,end:int,strict:boolean,value:string,before:string,after:string>>)"
    named = f"transform({found}, (v, i) -> named_struct('gap', {gaps}[i], 'value', v, 'next', {gaps}[i + 1]))"
    return f"if(size({found}) > 0, aggregate({named}, named_struct('at', 0, 'out', {none}), (acc, x) -> {step}, acc -> acc.out), {none})"


def _digits(value: str) -> str:
    return f"regexp_replace({value}, '[^0-9]', '')"


def _octets(value: str) -> str:
    return f"forall(regexp_extract_all({value}, '[0-9]+', 0), o -> length(ltrim('0', o)) <= 3 and coalesce(try_cast(o as int), 999) <= 255)"


def _valid(c: str = "c") -> str:
    """Whether the bare value of a candidate is well formed for its kind."""
    digits = _digits(f"{c}.value")
    return f"""case {c}.kind
        when 0 then {c}.value rlike '[A-Za-z]{{2,}} ?$|[A-Za-z]{{2,}}$'
        when 1 then {_octets(f"{c}.value")}
        when 2 then length({digits}) between 14 and 19 and luhn_check({digits})
        else length({digits}) between 10 and 15 end"""


def _passes(c: str = "c") -> str:
    """Whether a match of a strict pattern counts."""
    return f"({c}.kind = 0 or {_valid(c)})"


def _described(c: str = "c") -> str:
    """The features of one candidate as small whole numbers."""
    digits = _digits(f"{c}.value")
    side = lambda t: f"case when {t} = '' then 0 when {t} rlike '^\\\\s$' then 1 when {t} rlike '^[0-9]$' then 2 when {t} rlike '^[\\\\p{{L}}]$' then 3 else 4 end"
    cue = "case {c}.kind " + " ".join(f"when {i} then {{c}}.before rlike {_literal(CUES[k])}" for i, k in enumerate(KINDS)) + " end"
    return f"""named_struct(
        'digits', least(length({digits}), 20),
        'groups', least(size(regexp_extract_all({c}.value, '[0-9]+', 0)), 6),
        'separators', cast({c}.value like '% %' as int) + 2 * cast({c}.value like '%-%' as int) + 4 * cast({c}.value like '%.%' as int) + 8 * cast({c}.value rlike '[(\\\\[{{]' as int),
        'valid', cast({_valid(c)} as int),
        'left_side', {side(f"right({c}.before, 1)")},
        'right_side', {side(f"left({c}.after, 1)")},
        'cue', cast({cue.format(c=c)} as int),
        'plus', cast({c}.value like '+%' or {c}.before like '%+' as int),
        'uniform', cast({digits} rlike '^(.)\\\\1*$' as int))"""


def candidates(docs: DataFrame, text: str = "text", name: str = "candidates") -> DataFrame:
    """All rows and columns with the candidates of each whole text added: strict matches, marked if they pass, and wide ones.

    Places are code points, ends exclusive. Null text counts as empty. Narrow.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    own = "w"  # no column starts so, so none is overwritten
    while any(c.lower().startswith(own) for c in docs.columns):
        own += "_"
    rows = docs.withColumn(f"{own}t", content)
    generators = [(s, k, p) for s, ps in ((True, STRICT), (False, WIDE)) for k, p in ps.items()]
    rows = rows.withColumns({f"{own}f{i}": F.expr(f"regexp_extract_all({own}t, {_literal(p)}, 0)") for i, (_, _, p) in enumerate(generators)})
    rows = rows.withColumns({f"{own}g{i}": F.expr(f"if(size({own}f{i}) > 0, split({own}t, {_literal(p)}, -1), array(''))") for i, (_, _, p) in enumerate(generators)})
    placed = [_placed(f"{own}f{i}", f"{own}g{i}", KINDS.index(k), s) for i, (s, k, _) in enumerate(generators)]
    same = ", ".join(f"'{f}', c.{f}" for f in ("start", "kind", "end"))
    rest = ", ".join(f"'{f}', c.{f}" for f in ("value", "before", "after"))
    matched = f"transform(concat({', '.join(placed[: len(KINDS)])}), c -> named_struct({same}, 'strict', {_passes()}, {rest}))"
    rows = rows.withColumn(f"{own}strict", F.expr(matched))
    wide = f"filter(concat({', '.join(placed[len(KINDS):])}), c -> not exists({own}strict, s -> s.kind = c.kind and s.start = c.start and s.end = c.end))"
    return rows.select(*[F.col(c) for c in docs.columns], F.expr(f"concat({own}strict, {wide})").alias(name))


@dataclass
class Model:
    """Trees (feature, cut, then the same and a value for both sides) for each kind, and the least score that is redacted."""

    trees: list[list[tuple]] = field(default_factory=lambda: [[] for _ in KINDS])
    thresholds: list[float] = field(default_factory=lambda: [float("inf")] * len(KINDS))

    def score_sql(self, features: str, kind: int) -> str:
        def leaf(node) -> str:
            if isinstance(node, float):
                return f"{node!r}D"
            name, cut, low, high = node
            return f"if({features}.{name} <= {cut}, {leaf(low)}, {leaf(high)})"

        return " + ".join(leaf(tree) for tree in self.trees[kind]) or "0D"


def _best_cut(x: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[float, int, int] | None:
    """The split of largest gain: (gain, feature, cut)."""
    best = None
    for f in range(x.shape[1]):
        for cut in np.unique(x[:, f])[:-1]:
            low = x[:, f] <= cut
            gl, hl, gh, hh = g[low].sum(), h[low].sum(), g[~low].sum(), h[~low].sum()
            gain = gl * gl / (hl + 1) + gh * gh / (hh + 1) - (gl + gh) ** 2 / (hl + hh + 1)
            if gain > 1e-6 and (best is None or gain > best[0] + 1e-9):
                best = (gain, f, int(cut))
    return best


def _grow(x: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int):
    cut = _best_cut(x, g, h) if depth else None
    if cut is None:
        return float(round(-RATE * g.sum() / (h.sum() + 1), 9))
    low = x[:, cut[1]] <= cut[2]
    return (FEATURES[cut[1]], cut[2], _grow(x[low], g[low], h[low], depth - 1), _grow(x[~low], g[~low], h[~low], depth - 1))


def _value(tree, x: np.ndarray) -> np.ndarray:
    if isinstance(tree, float):
        return np.full(len(x), tree)
    name, cut, low, high = tree
    return np.where(x[:, FEATURES.index(name)] <= cut, _value(low, x), _value(high, x))


def fit(x: np.ndarray, positive: np.ndarray, total: np.ndarray) -> tuple[list, float]:
    """Boosted trees of depth 3 for logistic loss on counted feature rows, and the calibrated threshold.

    The threshold is the least score above which the share of true candidates,
    counted downwards, stays at ``PRECISION``; infinite without ``SUPPORT`` of them.
    """
    score, trees = np.zeros(len(x)), []
    for _ in range(TREES if 0 < positive.sum() < total.sum() else 0):
        p = 1 / (1 + np.exp(-score))
        tree = _grow(x, total * p - positive, total * p * (1 - p), 3)
        trees.append(tree)
        score += _value(tree, x)
    order = np.argsort(-score, kind="stable")
    hits, seen = np.cumsum(positive[order]), np.cumsum(total[order])
    last = np.append(np.diff(score[order]) != 0, True)
    good = last & (hits >= PRECISION * seen) & (hits >= SUPPORT) & bool(trees)
    return trees, float(score[order][np.flatnonzero(good)[-1]]) if good.any() else float("inf")


def train(found: DataFrame, name: str = "candidates") -> Model:
    """Fit on the candidates of all rows: counted by kind and features, which bounds what reaches the driver.

    The truth of a candidate is whether it lies on a strict span of its kind.
    """
    on_strict = f"exists(filter({name}, s -> s.strict), s -> s.kind = c.kind and s.start < c.end and c.start < s.end)"
    rows = found.select(F.expr(f"inline(transform({name}, c -> named_struct('kind', c.kind, 'f', {_described()}, 'true', cast({on_strict} as int))))"))
    counted = rows.groupBy("kind", *[f"f.{f}" for f in FEATURES]).agg(F.sum("true").alias("hits"), F.count("*").alias("n"))
    table = sorted(tuple(r) for r in counted.collect())
    model = Model()
    for kind in range(len(KINDS)):
        own = np.array([r for r in table if r[0] == kind], dtype=np.int64).reshape(-1, len(FEATURES) + 3)
        if len(own):
            x, hits, n = own[:, 1:-2], own[:, -2].astype(float), own[:, -1].astype(float)
            model.trees[kind], model.thresholds[kind] = fit(x, hits, n)
    return model


def spans(found: DataFrame, model: Model, name: str = "candidates", out: str = "spans") -> DataFrame:
    """Replace the candidates by the spans to redact: structs of start, kind, end, strict, by start and then kind.

    All strict spans stay; another candidate is added if it is well formed, passes
    its threshold and meets neither a strict span nor an earlier added one of its kind.
    """
    scored = []
    for kind, threshold in enumerate(model.thresholds):
        if threshold < float("inf"):
            chosen = f"filter({name}, c -> not c.strict and c.kind = {kind} and {_valid()} and not exists({name}, s -> s.strict and s.kind = c.kind and s.start < c.end and c.start < s.end))"
            described = f"transform({chosen}, c -> named_struct('c', c, 'f', {_described()}))"
            scored.append(f"transform(filter({described}, x -> {model.score_sql('x.f', kind)} >= {threshold!r}D), x -> x.c)")
    slim = "named_struct('start', c.start, 'kind', c.kind, 'end', c.end, 'strict', c.strict)"
    strict = f"transform(filter({name}, c -> c.strict), c -> {slim})"
    added = f"array_sort(transform(concat({', '.join(scored)}), c -> {slim}))" if scored else None
    if added:
        fitting = f"not exists(acc, a -> a.kind = c.kind and a.start < c.end and c.start < a.end)"
        added = f"aggregate({added}, cast(array() as array<struct<start:int,kind:int,end:int,strict:boolean>>), (acc, c) -> if({fitting}, concat(acc, array(c)), acc))"
    everything = f"array_sort(concat({strict}, {added}))" if added else f"array_sort({strict})"
    return found.select(*[c for c in found.columns if c not in (name, out)], F.expr(everything).alias(out))


def written(column: str = "spans", where: str = "true") -> Column:
    """Spans as text: kind:start:end, joined by commas."""
    kind = "element_at(array(" + ", ".join(f"'{k}'" for k in KINDS) + "), s.kind + 1)"
    return F.expr(f"array_join(transform(filter({column}, s -> {where}), s -> concat_ws(':', {kind}, s.start, s.end)), ',')")


def redacted(text: str = "text", column: str = "spans") -> Column:
    """The text with every span replaced by its kind in square brackets; null stays null."""
    tag = "element_at(array(" + ", ".join(f"'[{k.upper()}]'" for k in KINDS) + "), s.kind + 1)"
    step = f"if(s.end <= acc.at, acc, named_struct('at', s.end, 'out', concat(acc.out, if(s.start >= acc.at, concat(substring(`{text}`, acc.at + 1, s.start - acc.at), {tag}), ''))))"
    whole = f"aggregate({column}, named_struct('at', 0, 'out', ''), (acc, s) -> {step}, acc -> concat(acc.out, substring(`{text}`, acc.at + 1)))"
    return F.expr(f"if(size({column}) > 0, {whole}, `{text}`)")


def find(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and the spans of every document (see :func:`spans`); the texts are read once.

    Null and empty texts have none; repeated and null keys stay as they are;
    other columns are not carried; an empty table gives an empty one.
    """
    found = cut_lineage(candidates(docs.select(F.col(key), F.col(text).alias("__text")), "__text").drop("__text"), "candidates")
    return spans(found, train(found))


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """All rows and columns with the personal data in ``text`` replaced.

    Null texts stay null and empty ones empty; repeated rows are redacted alike, texts
    of any length whole; columns may have any name and keep their values; an empty
    table gives an empty one.
    """
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    at = f"c{docs.columns.index(text)}"
    model = train(candidates(plain.select(at), at, "found"), "found")
    marked = spans(candidates(plain, at, "found"), model, "found", "chosen")
    return marked.withColumn(at, redacted(at, "chosen")).select(*plain.columns).toDF(*docs.columns)
