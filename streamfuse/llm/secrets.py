"""Secret scans by a trigram index, in DataFrame functions only.

Every rule is a regular expression. Its Boolean trigram query is derived from it: a walk over the parsed expression follows
the strings that every match has somewhere, as long as they are few; each stretch of them makes an OR of strings, each an AND
of its trigrams, and a match meets all of these. The index lists, for each trigram the rules ask for, the documents that
hold it. Intersecting its postings leaves candidates for each rule, and only they are matched with the regular expression. A
rule whose query is empty is matched with every text.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce
from re import _constants as ops
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamfuse.llm.common import ascii_lower, whole, written

# Candidates up to this number are sent to every task (16 bytes each); more are joined by shuffle.
BROADCAST_CANDIDATES = 500_000
# Strings that the walk over an expression follows at a time, and repetitions that it writes out.
STRINGS = 32
REPEATS = 8
# Matches whose positions are added up together; longer lists go part by part.
SPAN_PART = 64


@dataclass(frozen=True)
class Rule:
    """``group``: what must have ``least`` code points; 0 is the whole match."""

    kind: str
    pattern: str
    group: int
    least: int


def either_case(word: str) -> str:
    """A pattern of the word in capital or small letters, for ASCII only."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_ASSIGNED = ("password", "passwd", "secret", "token")
_NAMES = "|".join([*map(either_case, _ASSIGNED), f"{either_case('api')}_?{either_case('key')}"])

# Fixed patterns. Runs of one class are written with the least length where that finds the same runs.
BASE_RULES = (
    Rule(
        "assign",
        rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        12,
    ),
    Rule("access", "AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", "[0-9a-f]{16,}", 0, 16),
)
MORE_RULES = (
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}", 0, 40),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}", 0, 15),
    Rule("stripe", "[rs]k_live_[A-Za-z0-9]{16,}", 0, 24),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 30),
    Rule("pem", r"-----BEGIN\x20[A-Z\x20]*PRIVATE\x20KEY-----", 0, 20),
)
RULES = BASE_RULES + MORE_RULES


# A clause is what must be held together; a group is met by any of its clauses, a query by all of its groups.
Clause = frozenset[str]
Query = list[list[Clause]]


def trigrams(literal: str) -> Clause:
    return frozenset(literal[i : i + 3] for i in range(len(literal) - 2))


def trigram_query(pattern: str) -> Query:
    """The trigrams that a lower-cased text must hold to match; empty if nothing can be said."""
    groups: Query = []
    _close(_walk(parser.parse(pattern), {""}, groups), groups)
    return groups


def _close(strings: set[str], groups: Query) -> None:
    """Every match holds one of the strings."""
    clauses = {trigrams(s) for s in strings}
    if all(clauses):
        least = [c for c in clauses if not any(d < c for d in clauses)]
        groups.append(sorted(least, key=sorted))


def _fold(c: int) -> str:
    return chr(c + 32) if 0x41 <= c <= 0x5A else chr(c)


def _characters(items: Iterable[tuple]) -> set[str] | None:
    """Lower-cased members of a character class; None if there are many or it isn't a plain one."""
    out: set[str] = set()
    for op, value in items:
        if op is ops.LITERAL:
            out.add(_fold(value))
        elif op is ops.RANGE and value[1] - value[0] < 128:
            out.update(_fold(c) for c in range(value[0], value[1] + 1))
        else:
            return None
    return out


def _walk(items: Iterable[tuple], strings: set[str], groups: Query) -> set[str]:
    """Follow ``strings``, one of which ends where the items begin, through the items.

    Where they get too many or nothing is known, they are closed into a group and the walk begins anew. The result is
    what ends where the items end.
    """

    def times(more: set[str]) -> set[str] | None:
        made = {s + m for s in strings for m in more}
        return made if len(made) <= STRINGS else None

    for op, value in items:
        follow: set[str] | None = None
        if op is ops.LITERAL:
            follow = times({_fold(value)})
        elif op is ops.IN:
            members = _characters(value)
            follow = times(members) if members else None
        elif op is ops.SUBPATTERN:
            follow = _walk(value[-1], strings, groups)
        elif op is ops.AT:
            follow = strings
        elif op is ops.BRANCH:
            ways = [(part, []) for part in value[1]]
            ends = [_walk(part, strings, own) for part, own in ways]
            if not any(own for _, own in ways):
                joined = set().union(*ends)
                follow = joined if len(joined) <= STRINGS else None
            else:
                # Each way has groups of its own, and one of the ways is gone.
                for end, (_, own) in zip(ends, ways, strict=True):
                    _close(end, own)
                if all(own for _, own in ways):
                    groups.append(sorted({c for _, own in ways for c in own[0]}, key=sorted))
                strings = {""}
                continue
        elif op in (ops.MAX_REPEAT, ops.MIN_REPEAT):
            least, most, part = value
            if (least, most) == (0, 1):
                own: Query = []
                ends = _walk(part, strings, own) | strings
                follow = ends if not own and len(ends) <= STRINGS else None
            elif least:
                follow = strings
                for _ in range(least if least <= REPEATS else 1):
                    follow = _walk(part, follow, groups)
                if least > REPEATS or most != least:
                    _close(follow, groups)
                    follow = {""}
        if follow is None:
            _close(strings, groups)
            follow = {""}
        strings = follow
    return strings


def trigram_queries(rules: Sequence[Rule]) -> dict[str, Query]:
    """The queries of the rules that have one."""
    made = {r.kind: trigram_query(r.pattern) for r in rules}
    return {kind: query for kind, query in made.items() if query}


def postings(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The index: one row (trigram, doc_id) for each trigram of the rules that a text holds."""
    asked = sorted({t for q in trigram_queries(rules).values() for group in q for clause in group for t in clause})
    held = F.filter(F.array(*map(F.lit, asked)), lambda t: F.contains(F.col("_low"), t))
    low = docs.select("doc_id", ascii_lower(whole("text")).alias("_low"))
    return low.select("doc_id", F.explode(held).alias("trigram"))


def candidates(index: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(doc_id, kinds): the rules whose trigram query a document meets. Postings are intersected by
    counting: a document holds a literal's trigrams if it stands in as many of their lists."""
    spark = index.sparkSession
    clauses = [
        (kind, g, i, t, len(clause), len(query))
        for kind, query in trigram_queries(rules).items()
        for g, group in enumerate(query)
        for i, clause in enumerate(group)
        for t in sorted(clause)
    ]
    table = spark.createDataFrame(clauses, "kind string, grp int, clause int, trigram string, needed int, groups int")
    # The clauses are as many as the rules have trigrams.
    met = (
        index.join(F.broadcast(table), "trigram")
        .groupBy("doc_id", "kind", "grp", "clause", "needed", "groups")
        .agg(F.count_distinct("trigram").alias("found"))
        .filter(F.col("found") == F.col("needed"))
    )
    whole_query = met.groupBy("doc_id", "kind", "groups").agg(F.count_distinct("grp").alias("found"))
    whole_query = whole_query.filter(F.col("found") == F.col("groups"))
    return whole_query.groupBy("doc_id").agg(F.sort_array(F.collect_set("kind")).alias("kinds"))


def _spans(text: Column, rule: Rule) -> Column:
    """array<struct<start, end>> of the matches that are long enough, in code points, end exclusive.

    Splitting at the matches gives the gaps between them; gaps and matches in turn add up to positions.
    """
    gaps = F.transform(F.split(text, rule.pattern), F.char_length)
    lengths = F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)), F.char_length)
    whole_match = rule.group == 0
    counted = (
        lengths
        if whole_match
        else F.transform(
            F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)), F.char_length
        )
    )
    pairs = F.arrays_zip(
        F.slice(gaps, 1, F.size(lengths)).alias("gap"), lengths.alias("len"), counted.alias("counted")
    )
    nothing = F.array().cast("array<struct<s:int,e:int,n:int>>")

    def step(acc: Column, p: Column) -> Column:
        s = acc["at"] + p["gap"]
        e = s + p["len"]
        one = F.struct(s.alias("s"), e.alias("e"), p["counted"].alias("n"))
        return F.struct(e.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    def placed(found: Column) -> Column:
        """A list is copied whenever a match is added to it, so it is built in short parts that know where they begin."""
        last = F.floor((F.size(found) - 1) / SPAN_PART).cast("int")
        numbers = F.when(F.size(found) > 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
        parts = F.transform(numbers, lambda i: F.slice(found, i * SPAN_PART + 1, F.lit(SPAN_PART)))
        sizes = F.transform(parts, lambda part: F.aggregate(part, F.lit(0), lambda a, p: a + p["gap"] + p["len"]))
        begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        starts = F.aggregate(
            sizes,
            begin,
            lambda a, n: F.struct((a["at"] + n).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")),
            lambda a: a["out"],
        )

        def spans(part: Column, at: Column) -> Column:
            return F.aggregate(part, F.struct(at.alias("at"), nothing.alias("out")), step, lambda a: a["out"])

        return F.flatten(F.zip_with(parts, starts, spans))

    # In a list of one, so that the matches are found once and not for each part.
    every = F.get(F.transform(F.array(pairs), placed), F.lit(0))
    return F.filter(every, lambda m: m["n"] >= rule.least)


def _tag(kind: int):
    # A lambda of two parameters would get the index as the second.
    return lambda m: F.struct(m["s"].alias("s"), F.lit(kind).alias("kind"), m["e"].alias("e"))


def _is_kind(kind: int):
    return lambda m: m["kind"] == kind


def verify(docs: DataFrame, found: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Add ``_spans``: the matches of the rules each document is a candidate for."""
    rows = docs.withColumn("_text", whole("text"))
    small = found.count() <= BROADCAST_CANDIDATES
    found = found.select(F.col("doc_id").alias("_id"), "kinds")
    here = F.col("doc_id").eqNullSafe(F.col("_id"))
    rows = rows.join(F.broadcast(found) if small else found, here, "left")
    none = F.array().cast("array<struct<s:int,kind:int,e:int>>")
    parts, asked = [], trigram_queries(rules)
    for i, r in enumerate(rules):
        tagged = F.transform(_spans(F.col("_text"), r), _tag(i))
        wanted = F.rlike("_text", F.lit(r.pattern))
        if r.kind in asked:
            wanted = F.coalesce(F.array_contains("kinds", r.kind), F.lit(False)) & wanted
        parts.append(F.when(wanted, tagged).otherwise(none))
    spans = reduce(lambda a, b: F.concat(a, b), parts)
    # Sorted by start, then by the rules' order, then by end.
    return rows.withColumn("_spans", F.sort_array(spans)).drop("_id", "_text", "kinds")


def _listing(spans: Column, rules: Sequence[Rule]) -> Column:
    names = F.array(*[F.lit(r.kind) for r in rules])
    texts = F.transform(
        spans, lambda m: F.concat_ws(":", F.get(names, m["kind"]), m["s"].cast("string"), m["e"].cast("string"))
    )
    return F.array_join(texts, ",")


def scan_secrets(docs: DataFrame, more: Sequence[Rule] = MORE_RULES) -> DataFrame:
    """Per document the number of secrets of each base kind and all spans.

    A null text is empty and has none. A very long text is scanned whole, in time that grows with its length and matches. Repeated rows and rows that share a doc_id, null included, are
    each judged by their own text. Other columns of ``docs`` are not looked at. The candidates are
    written to the shared folder, because their number decides how they are joined.
    """
    rules = BASE_RULES + tuple(more)
    docs = docs.select("doc_id", "text")
    found = written(candidates(postings(docs, rules), rules), "secret-candidates")
    seen = verify(docs, found, rules)
    base = len(BASE_RULES)
    own = F.filter("_spans", lambda m: m["kind"] < base)
    counts = [
        F.size(F.filter("_spans", _is_kind(i))).cast("bigint").alias(f"n_{r.kind}")
        for i, r in enumerate(BASE_RULES)
    ]
    return seen.select(
        "doc_id",
        *counts,
        F.sha2(_listing(own, rules), 256).alias("base_sha256"),
        _listing(F.col("_spans"), rules).alias("spans"),
    )


def oracle_sql(rules: Sequence[Rule] = RULES) -> str:
    """The same spans in SQL: every rule on every text, positions from the gaps between matches."""
    parts = []
    for i, r in enumerate(rules):
        p = r.pattern.replace("'", "''")
        parts.append(
            f"SELECT r, {i} AS k, '{r.kind}' AS kind, {r.group} AS grp, {r.least} AS least,"
            f" string_split_regex(t, '{p}') AS gaps, regexp_extract_all(t, '{p}') AS found,"
            f" regexp_extract_all(t, '{p}', {r.group}) AS counted FROM d"
        )
    union = " UNION ALL ".join(parts)
    counts = ", ".join(
        f"coalesce(count(*) FILTER (k = {i}), 0) AS n_{r.kind}" for i, r in enumerate(BASE_RULES)
    )
    listing = "coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k){f}, '')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
every AS ({union}),
pairs AS (SELECT r, k, kind, least, gaps, found, counted, unnest(range(1, len(found) + 1)) AS i FROM every),
spans AS (
  SELECT r, k, kind,
    list_sum([length(x) FOR x IN gaps[1:i]])
      + coalesce(list_sum([length(x) FOR x IN found[1:i - 1]]), 0) AS s,
    s + length(found[i]) AS e
  FROM pairs WHERE length(counted[i]) >= least),
told AS (
  SELECT r, {counts},
    {listing.format(f=f" FILTER (k < {len(BASE_RULES)})")} AS base,
    {listing.format(f="")} AS spans
  FROM spans GROUP BY r)
SELECT doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in BASE_RULES)},
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN told USING (r)"""
