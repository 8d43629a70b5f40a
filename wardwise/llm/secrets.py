"""Secret scans over a trigram inverted index.

From each rule's regex a Boolean query over trigrams is derived (alternatives of trigram sets that every
match must contain). The index holds postings (trigram, document) for the trigrams that the rules ask
for; intersecting postings gives the candidate documents of a rule, and only those are searched with
the regex. A rule without mandatory trigrams scans every document. Trigrams are of the lower-cased text.
All steps are DataFrame functions.
"""

from __future__ import annotations

from dataclasses import dataclass
from re import _constants as op
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """Matches of `pattern` are leftmost and non-overlapping; those whose `group` is shorter than
    `least` code points are dropped after matching."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


BASE_RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", r"[0-9a-f]{32,}"),
)
#: A private key to its END line, which is the next five hyphens; without one, to the end of its base64 lines.
PEM = (r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"
       r"(?:[^-]*+(?:-{1,4}[^-]++){0,64}+-----END [A-Z ]{0,40}PRIVATE KEY-----"
       r"|(?:(?:\s|\\[rn])*+(?:Proc-Type|DEK-Info):[^\r\n]{0,200}){0,4}+"
       r"(?:(?:\s|\\[rn])*+[A-Za-z0-9+/]{16,}+={0,2}){0,1000}+"
       r"(?:(?:\r?\n|\\n)[A-Za-z0-9+/]{1,15}+={0,2}(?![^\s\x22\x27\\]))?)")
RULES = (
    *BASE_RULES,
    Rule("pem", PEM),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
)
MOST_EXACT, MOST_ALTERNATIVES, MOST_TRIGRAMS = 64, 64, 16
Query = frozenset  # of frozensets of trigrams: any of them, each with all its trigrams


def _least(query: set[frozenset[str]]) -> Query:
    return frozenset(a for a in query if not any(b < a for b in query))


def _both(a: Query, b: Query) -> Query:
    made = {x | y for x in a for y in b}
    return _least(made) if len(made) <= MOST_ALTERNATIVES else a


ALWAYS: Query = frozenset({frozenset()})


def _grams(strings: set[str]) -> Query:
    return _least({frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings})


def _exact(node) -> set[str] | None:
    """The strings that a node matches, if they are few."""
    kind, arg = node
    if kind is op.LITERAL:
        return {chr(arg).lower()}
    if kind is op.IN:
        found: set[str] = set()
        for k, a in arg:
            if k is op.LITERAL:
                found.add(chr(a).lower())
            elif k is op.RANGE and a[1] - a[0] < 8:
                found |= {chr(c).lower() for c in range(a[0], a[1] + 1)}
            else:
                return None
        return found if len(found) <= 8 else None
    if kind is op.SUBPATTERN:
        return _exact_seq(arg[3])
    if kind is op.BRANCH:
        parts = [_exact_seq(x) for x in arg[1]]
        return None if None in parts else set().union(*parts)
    if kind is op.MAX_REPEAT and arg[1] is not op.MAXREPEAT and arg[1] <= 5:
        once = _exact_seq(arg[2])
        if once is None or len(once) ** arg[1] > MOST_EXACT:
            return None
        runs, found = {""}, set()
        for n in range(arg[1] + 1):
            found |= runs if n >= arg[0] else set()
            runs = {a + b for a in runs for b in once}
        return found
    return None


def _exact_seq(nodes) -> set[str] | None:
    run = {""}
    for node in nodes:
        part = _exact(node)
        if part is None or len(run) * len(part) > MOST_EXACT:
            return None
        run = {a + b for a in run for b in part}
    return run


def _need(nodes) -> Query:
    need, run = ALWAYS, {""}
    for node in nodes:
        part = _exact(node)
        if part is not None and len(run) * len(part) <= MOST_EXACT:
            run = {a + b for a in run for b in part}
            continue
        need, run = _both(need, _grams(run)), {""}
        kind, arg = node
        if part is not None:
            run = part
        elif kind is op.SUBPATTERN:
            need = _both(need, _need(arg[3]))
        elif kind is op.BRANCH:
            need = _both(need, _least(set().union(*(_need(x) for x in arg[1]))))
        elif kind is op.MAX_REPEAT and arg[0] > 0:
            need = _both(need, _need(arg[2]))
    return _both(need, _grams(run))


def trigram_query(pattern: str) -> Query:
    """Alternatives of trigram sets; one empty set if no trigram is mandatory."""
    return frozenset(frozenset(sorted(a)[:MOST_TRIGRAMS]) for a in _need(parser.parse(pattern)))


def postings(docs: DataFrame, trigrams: list[str], key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (id, trigram), one per document and asked trigram in it; id is a hash of the key."""
    low = docs.select(F.xxhash64(key).alias("id"), F.lower(F.col(text)).alias("low"))
    asked = F.array(*map(F.lit, trigrams))
    return low.select("id", F.explode(F.filter(asked, lambda t: F.contains(F.col("low"), t))).alias("trigram"))


def candidates(docs: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "doc_id",
               text: str = "text") -> DataFrame:
    """Rows (id, rules): a bit per indexed rule whose trigram query the document's postings fulfil."""
    asked = [(n, c, t, i, len(a)) for n, r in enumerate(rules) for c, a in enumerate(trigram_query(r.pattern))
             for i, t in enumerate(sorted(a))]
    spark = docs.sparkSession
    want = spark.createDataFrame(asked, "rule int, alternative int, trigram string, place int, size int")
    bit = lambda c: F.call_function("shiftleft", F.lit(1).cast("long"), F.col(c))
    if not asked:
        return spark.createDataFrame([], "id long, rules long")
    found = postings(docs, sorted({t for _, _, t, _, _ in asked}), key, text)
    # the query table has some rows per rule
    met = (found.join(F.broadcast(want), "trigram").groupBy("id", "rule", "alternative", "size")
           .agg(F.bit_or(bit("place")).alias("seen")).where("seen = shiftleft(1L, size) - 1"))
    return met.groupBy("id").agg(F.bit_or(bit("rule")).alias("rules"))


def _with_candidates(docs: DataFrame, rules: tuple[Rule, ...], key: str, text: str) -> DataFrame:
    scanned = sum(1 << n for n, r in enumerate(rules) if frozenset() in trigram_query(r.pattern))
    found = candidates(docs, rules, key, text).select(F.col("id").alias("_id"), F.col("rules").alias("_found"))
    return (docs.withColumn("_id", F.xxhash64(key)).join(found, "_id", "left")
            .withColumn("_rules", F.coalesce("_found", F.lit(0).cast("long")).bitwiseOR(F.lit(scanned).cast("long")))
            .drop("_id", "_found"))


def let(value: Column, body) -> Column:
    """body(value), with the value worked out once however often the body uses it."""
    return F.get(F.transform(F.array(value), body), 0)


def _running(a: Column, step, start: int) -> Column:
    """step over a's first 1, 2, ... elements, by blocks of 256, so that long arrays cost little."""
    first, block = F.lit(start).cast("long"), 256

    def steps(x: Column) -> Column:
        return F.aggregate(x, F.array().cast("array<long>"),
                           lambda acc, v: F.concat(acc, F.array(step(F.coalesce(F.get(acc, F.size(acc) - 1), first), v))))

    def joined(blocks: Column) -> Column:
        return let(steps(F.transform(blocks, lambda b: F.aggregate(b, first, step))), lambda before: F.flatten(
            F.transform(blocks, lambda b, i: let(F.coalesce(F.get(before, i - 1), first), lambda off: F.transform(
                steps(b), lambda x: step(x, off))))))

    return let(a, lambda v: let(F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(v), F.lit(1)), F.lit(block)), lambda s: F.slice(v, s, block)), joined))


def running_sums(a: Column) -> Column:
    return _running(a, lambda x, y: x + y, 0)


def running_most(a: Column) -> Column:
    """Greatest of a's first 1, 2, ... elements, none of them negative."""
    return _running(a, lambda x, y: F.greatest(x, y), 0)


SPANS = "array<struct<start:long,rank:int,end:long>>"


def _hit(rule: Rule, n: int, text: Column) -> Column:
    chosen = F.col("_rules").bitwiseAND(F.lit(1 << n).cast("long")) != 0
    return chosen & text.rlike(rule.pattern)


def _spans(rule: Rule, n: int, text: Column) -> Column:
    """Spans of one rule: the pieces between matches give the places. Each array is made once a row."""
    pattern = F.lit(rule.pattern)

    def of(matches: Column) -> Column:
        before = F.concat(F.array(F.lit("")), matches)
        steps = F.zip_with(F.split(text, rule.pattern, -1), before, lambda p, m: (
            F.char_length(p) + F.char_length(m)).cast("long"))
        spans = F.zip_with(matches, F.slice(running_sums(steps), 1, F.size(matches)), lambda m, s: F.struct(
            s.alias("start"), F.lit(n).alias("rank"), (s + F.char_length(m)).alias("end")))
        if rule.least:
            values = F.regexp_extract_all(text, pattern, F.lit(rule.group))
            spans = F.array_compact(F.zip_with(spans, values, lambda s, v: F.when(F.char_length(v) >= rule.least, s)))
        return spans

    found = let(F.regexp_extract_all(text, pattern, F.lit(0)), of)
    return F.when(_hit(rule, n, text), found.cast(SPANS)).otherwise(F.array().cast(SPANS))


def _all_spans(rules: tuple[Rule, ...], text: str) -> Column:
    whole = F.coalesce(F.col(text), F.lit(""))
    return F.sort_array(F.concat(*(_spans(r, n, whole) for n, r in enumerate(rules))))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with `spans`: array of (start, rank, end) in code points, end exclusive, by start, then rule.

    A null text is empty; repeated and null keys are searched row by row like any other row; a
    column named spans is replaced.
    """
    return _with_candidates(docs, rules, key, text).withColumn("spans", _all_spans(rules, text)).drop("_rules")


def listed(spans: Column, rules: tuple[Rule, ...]) -> Column:
    """kind:start:end of the given spans, comma-joined."""
    kinds = F.array(*(F.lit(r.kind) for r in rules))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(kinds, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def merged(spans: Column) -> Column:
    """Unions (start, end) of overlapping spans, from spans sorted by start."""

    def of(sorted_spans: Column, ends: Column) -> Column:
        heads = F.filter(F.transform(sorted_spans, lambda s, i: F.when(
            F.coalesce(s["start"] >= F.get(ends, i - 1), F.lit(True)), i)), lambda i: i.isNotNull())
        return let(heads, lambda h: F.transform(h, lambda i, k: F.struct(
            F.get(sorted_spans, i)["start"].alias("start"),
            F.get(ends, F.coalesce(F.get(h, k + 1), F.size(ends)) - 1).alias("end"))))

    return let(spans, lambda s: let(running_most(F.transform(s, lambda x: x["end"])), lambda e: of(s, e)))


def masked(text: Column, places: Column, mask: str) -> Column:
    """text with each of the disjoint places replaced; it is cut by blocks of 256 places, then by place."""
    block = 256
    part = lambda t, lo, hi: F.substring(t, (lo + 1).cast("int"), (hi - lo).cast("int"))
    end = lambda p, i: F.coalesce(F.get(p, i)["end"], F.lit(0).cast("long"))

    def of(p: Column) -> Column:
        def in_block(first: Column) -> Column:
            base = end(p, first - 2)
            inside = F.slice(p, first, block)
            return let(F.struct(base.alias("base"), inside.alias("inside"), part(
                text, base, end(inside, F.size(inside) - 1)).alias("text")), lambda b: F.array_join(
                    F.transform(b["inside"], lambda s, i: F.concat(part(
                        b["text"], F.coalesce(F.get(b["inside"], i - 1)["end"], b["base"]) - b["base"], s["start"] - b["base"]),
                        F.lit(mask))), ""))

        blocks = F.transform(F.sequence(F.lit(1), F.size(p), F.lit(block)), in_block)
        return F.concat(F.array_join(blocks, ""), part(text, end(p, F.size(p) - 1), F.char_length(text).cast("long")))

    return let(places, lambda p: F.when(F.size(p) > 0, of(p)).otherwise(text))


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "doc_id", text: str = "text",
           mask: str = "<SECRET>") -> DataFrame:
    """docs with every secret of the text replaced by `mask`: the spans of all rules in the original text, those
    that overlap as one. Null texts stay null."""
    found = _with_candidates(docs, rules, key, text)
    whole = masked(F.col(text), merged(_all_spans(rules, text)), mask)
    return found.withColumn(text, whole).drop("_rules").select(docs.columns)
