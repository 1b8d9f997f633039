"""Secret scans over a trigram inverted index."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

try:
    from re import _constants as sre, _parser as parser
except ImportError:  # before Python 3.11
    import sre_constants as sre, sre_parse as parser


@dataclass(frozen=True)
class Rule:
    """A kind of secret. A match counts if its ``group`` has at least ``least`` characters; the pattern must mean
    the same to Java and to Python."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


#: The three base kinds, in the order in which ties are listed.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]+", 0, 16),
)

#: Public formats of keys and tokens.
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
)

#: A Boolean query in conjunctive form: each set must have a trigram in the text. Empty: every text.
Clauses = list[frozenset[str]]


@dataclass
class _Part:
    """What is known of the strings that a part of a pattern matches: all of them (``exact``), or the clauses they
    fulfil and how they can begin and end. Everything is in lower case."""

    exact: frozenset[str] | None
    clauses: Clauses


def _grams(words: frozenset[str]) -> Clauses:
    """Every text that holds one of the words fulfils these clauses."""
    if not words or min(map(len, words)) < 3:
        return []
    each = [[w[i : i + 3] for i in range(len(w) - 2)] for w in words]
    if len(each) == 1:
        return [frozenset([g]) for g in each[0]]
    return [frozenset(g[0] for g in each), frozenset(g[-1] for g in each)]


def _any(parts: list[_Part], most: int) -> _Part:
    if all(p.exact is not None for p in parts):
        words = frozenset().union(*(p.exact for p in parts))
        if len(words) <= most:
            return _Part(words, [])
    each = [p.clauses or _grams(p.exact or frozenset()) for p in parts]
    if not all(each):
        return _Part(None, [])
    return _Part(None, [reduce(frozenset.union, (min(c, key=len) for c in each))])


def _row(items, most: int) -> _Part:
    """A sequence: neighbours that are exact are joined as long as they are few."""
    exact, clauses, whole = frozenset([""]), [], True
    for op, value in items:
        part = _part(op, value, most)
        joined = frozenset(a + b for a in exact for b in part.exact) if part.exact is not None and len(part.exact) * len(exact) <= most else None
        if joined is not None:
            exact = joined
            continue
        whole = False
        clauses += _grams(exact) + part.clauses + (_grams(part.exact) if part.exact is not None else [])
        exact = frozenset([""])
    return _Part(exact, []) if whole else _Part(None, clauses + _grams(exact))


def _part(op, value, most: int) -> _Part:
    if op is sre.LITERAL:
        return _Part(frozenset([chr(value).lower()]), [])
    if op is sre.IN:
        chars: set[str] = set()
        for kind, v in value:
            if kind is sre.LITERAL:
                chars.add(chr(v).lower())
            elif kind is sre.RANGE and v[1] - v[0] < most:
                chars |= {chr(c).lower() for c in range(v[0], v[1] + 1)}
            else:
                return _Part(None, [])
        return _Part(frozenset(chars), []) if len(chars) <= most else _Part(None, [])
    if op is sre.SUBPATTERN:
        return _row(value[-1], most)
    if op is sre.BRANCH:
        return _any([_row(x, most) for x in value[1]], most)
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
        low, high, items = value
        inner = _row(items, most)
        if inner.exact is not None and (low, high) == (0, 1):
            return _Part(inner.exact | {""}, [])
        if low == 0:
            return _Part(None, [])
        return _Part(None, inner.clauses or _grams(inner.exact or frozenset()))
    return _Part(None, [])


def trigram_query(pattern: str, most: int = 8, clauses: int = 3) -> Clauses:
    """The trigrams, in lower case, that a text needs so that the pattern can match: at least one of each set.

    Only sets of at most ``most`` alternatives are followed; an empty answer says that no trigram is mandatory.
    Of many sets those with the fewest vowels and spaces are kept, as they are rare in prose.
    """
    part = _row(parser.parse(pattern), most)
    found = part.clauses if part.exact is None else _grams(part.exact)
    found = dict.fromkeys(c for c in found if all(ord(x) < 128 for g in c for x in g))
    return sorted(found, key=lambda c: sum(x in "aeinorst " for g in c for x in g) / len(c))[:clauses]


def _anywhere(grams: Sequence[str]) -> str:
    """A pattern whose group 1 is each of the trigrams wherever it begins, overlaps too."""
    code = lambda c: f"\\x{ord(c):02x}"
    first = sorted({g[0] for g in grams})
    tails = lambda c: "|".join(code(g[1]) + code(g[2]) for g in grams if g[0] == c)
    return "(?=[" + "".join(map(code, first)) + "])(?=(" + "|".join(f"{code(c)}(?:{tails(c)})" for c in first) + "))"


def _spans(text: Column, rule: Rule, number: int) -> Column:
    """The matches of one rule as structs of start, order of the rule, and ``kind:start:end``.

    Splitting by the pattern gives the texts between its matches, so the lengths of both add up to the positions.
    """
    pattern = F.lit(rule.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    groups = F.regexp_extract_all(text, pattern, F.lit(rule.group))
    between = F.split(text, rule.pattern, -1)
    seen = F.struct(F.lit(0).cast("long").alias("at"), F.expr("cast(array() as array<struct<start:bigint,end:bigint,size:int>>)").alias("out"))
    pieces = F.zip_with(
        F.slice(between, F.lit(1), F.size(found)),
        F.zip_with(found, groups, lambda f, g: F.struct(F.length(f).alias("all"), F.length(g).alias("group"))),
        lambda b, f: F.struct(F.length(b).alias("gap"), f["all"].alias("all"), f["group"].alias("group")),
    )

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + x["all"]
        one = F.struct(start.alias("start"), end.alias("end"), x["group"].alias("size"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    spans = F.filter(F.aggregate(pieces, seen, step)["out"], lambda s: s["size"] >= rule.least)
    listed = F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"), F.lit(number).alias("rule"), s["end"].alias("end"),
            F.concat(F.lit(f"{rule.kind}:"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string")).alias("name"),
        ),
    )
    none = F.expr("cast(array() as array<struct<start:bigint,rule:int,end:bigint,name:string>>)")
    return F.when(F.size(found) > 0, listed).otherwise(none)


def scan(
    docs: DataFrame,
    rules: Sequence[Rule] = BASE + MORE,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Finds secrets in every whole text.

    Each rule's pattern is turned into a Boolean query over trigrams (in lower case). The index is built over the
    trigrams that occur in some query: its postings are rows (trigram, text). They are intersected by gathering each
    text's postings, at most one per trigram, and evaluating all queries on them. Only the texts that remain for a
    rule are searched with its pattern, leftmost and without overlaps. Rules without mandatory trigrams search all.

    A text's key in the index is its document id with a hash of the text: a common trigram never gathers in one
    task, and if two keys coincide a rule only searches more texts.

    Returns one row per row of ``docs``: the columns ``keep``, ``doc_id``, and ``found``, an array of structs (start, rule, end, name) of all
    spans by start and rule; positions are code points, ends exclusive. Null text: empty. Null ids, repeated rows and
    extra columns are allowed; empty table: no rows.
    """
    base = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in keep), F.lit(0).alias("_")).alias("row"),
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
    ).withColumn("key", F.struct(F.coalesce("doc_id", F.lit(0)).alias("id"), F.xxhash64("text").alias("hash")))
    wanted = {r: trigram_query(r.pattern) for r in rules}
    grams = sorted({g for clauses in wanted.values() for c in clauses for g in c})
    number = {g: i for i, g in enumerate(grams)}
    indexed = [r for r in rules if wanted[r]]
    if indexed:
        postings = base.select(
            "key", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(_anywhere(grams)), F.lit(1)))).alias("gram")
        )
        has = lambda g: F.coalesce(F.bool_or(F.col("gram") == g), F.lit(False))
        gathered = postings.groupBy("key").agg(*(has(g).alias(f"g{number[g]}") for g in grams))
        met = {
            r.kind: reduce(Column.__and__, (reduce(Column.__or__, (F.col(f"g{number[g]}") for g in sorted(c))) for c in wanted[r]))
            for r in indexed
        }
        candidates = gathered.select("key", *(v.alias(f"c_{k}") for k, v in met.items())).where(
            reduce(Column.__or__, (F.col(f"c_{k}") for k in met))
        )
        base = base.join(candidates, "key", "left")
    none = F.expr("cast(array() as array<struct<start:bigint,rule:int,end:bigint,name:string>>)")
    each = [
        F.when(F.col(f"c_{r.kind}"), _spans(F.col("text"), r, i)).otherwise(none)
        if wanted[r]
        else F.when(F.col("text").rlike(_least(r)), _spans(F.col("text"), r, i)).otherwise(none)
        for i, r in enumerate(rules)
    ]
    return base.select(*(F.col(f"row.`{c}`").alias(c) for c in keep), "doc_id", "text", F.array_sort(F.concat(*each)).alias("found"))


def _least(rule: Rule) -> str:
    """A pattern that matches wherever the rule has a match that counts, for a first look."""
    alone = rule.group == 0 and rule.least and re.fullmatch(r"\[[^\[\]\\]+\]\+", rule.pattern)  # a head would count as well
    return rule.pattern[:-1] + f"{{{rule.least},}}" if alone else rule.pattern


def digest(scanned: DataFrame, rules: Sequence[Rule] = BASE + MORE) -> DataFrame:
    """Counts of the base kinds, the SHA-256 of the base spans, and all spans as text."""
    base = {r.kind: i for i, r in enumerate(rules) if r in BASE}
    of = lambda i: F.size(F.filter("found", lambda s: s["rule"] == i)).cast("long")
    listed = F.array_join(F.transform(F.filter("found", lambda s: s["rule"].isin(*base.values())), lambda s: s["name"]), ",")
    return scanned.select(
        "doc_id",
        *(of(i).alias(f"n_{k}") for k, i in base.items()),
        F.sha2(listed, 256).alias("base_sha256"),
        F.array_join(F.transform("found", lambda s: s["name"]), ",").alias("spans"),
    )


def redacted(mark: str = "[SECRET]") -> Column:
    """The text of a scan with every span, overlapping ones as one, replaced by the mark."""
    seen = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        gap = F.substring(F.col("text"), (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        first = (acc["at"] == 0) & (acc["out"] == "")
        added = F.concat(acc["out"], F.when(fresh | first, gap).otherwise(F.lit("")), F.when(fresh, F.lit(mark)).otherwise(F.lit("")))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), added.alias("out"))

    done = F.aggregate("found", seen, step, lambda acc: F.concat(acc["out"], F.substring(F.col("text"), (acc["at"] + 1).cast("int"), F.length("text"))))
    return F.when(F.size("found") > 0, done).otherwise(F.col("text"))
