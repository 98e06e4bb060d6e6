"""Secret scans by a trigram inverted index.

Each rule is a regular expression.  From its syntax tree a Boolean query over trigrams is derived that
every match must satisfy: an OR of ANDs.  Texts are indexed by the trigrams that occur in any rule's
query; the postings (trigram, text) are intersected per AND by counting, and only the texts
that satisfy a rule's query are searched with its expression.  A text goes by a hash of the whole of it; equal hashes of
different texts share their candidate rules, which costs a search and loses nothing.  A rule without a mandatory trigram (a
character class only, such as hexadecimal runs) is searched in every text.

Positions come from SQL functions alone: ``split`` gives the text between the matches and
``regexp_extract_all`` the matches, both leftmost and non-overlapping, so running lengths are the
starts and ends, in code points.  A match of which the given group is shorter than the least length is
dropped after matching, as it has used up its text.

Base kinds are assign, access and hex; the rules of ``MORE`` add spans and change none of these.
Defined cases: null text is empty; texts are searched whole; two rules may report overlapping spans;
spans of equal start are ordered by kind as listed; rows of equal texts share postings and are
verified row by row, whatever their ids; repeated rows give repeated results; an empty table gives an empty table; other
columns pass, and result columns replace input columns of the same name.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from re import _constants as K
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recengine.llm.common import Scratch, fresh_name, with_results

#: A set of strings that grows beyond this is no longer followed exactly.
MOST_STRINGS = 96
#: Texts with candidate rules that are broadcast at most (a hash and a few numbers each); more are joined by a shuffle.
BROADCAST_TEXTS = 500_000


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    any_case: bool = False
    #: An expression that gives the same spans and is quicker to search; None: the pattern.
    search: str | None = None

    @property
    def java(self) -> str:
        return ("(?i)" if self.any_case else "") + (self.search or self.pattern)


# The base rules, then the added ones (formats of published kinds of credentials).
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8, True),
    # A run that is too short uses up only text in which no long enough run can begin, so the length may move inside.
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16, search=r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", r"[0-9a-f]+", 0, 32, search=r"[0-9a-f]{32,}"),
)
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,24}PRIVATE KEY-----"),
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{10,}[.]eyJ[A-Za-z0-9_-]{10,}[.][A-Za-z0-9_-]{10,}"),
    Rule("url_login", r"[a-z]{2,8}://[A-Za-z0-9_.-]{1,64}:[A-Za-z0-9_.~!*-]{4,64}@[A-Za-z0-9.-]+"),
)

Query = frozenset  # of frozensets of trigrams: an OR of ANDs; one empty AND means any text
ANY: Query = frozenset([frozenset()])


def simplest(q: Query) -> Query:
    """Without ANDs that another AND already covers."""
    return frozenset(a for a in q if not any(b < a for b in q))


def both(p: Query, q: Query) -> Query:
    out = simplest(frozenset(a | b for a in p for b in q))
    return out if len(out) <= MOST_STRINGS else p


def of_strings(strings: set[str]) -> Query:
    return simplest(frozenset(frozenset(s[i: i + 3] for i in range(len(s) - 2)) for s in strings))


def shape(items) -> tuple[set[str] | None, Query]:
    """What a sequence of syntax nodes matches: all of its strings if they are few, and a query every match satisfies."""
    exact: set[str] | None = {""}
    whole, query = True, ANY
    for op, value in items:
        own, need = node(op, value)
        if own is not None and exact is not None and len(own) * len(exact) <= MOST_STRINGS:
            exact = {a + b for a in exact for b in own}
            continue
        query = both(query, of_strings(exact) if exact is not None else ANY)
        whole = False
        if own is not None:
            exact = own
        else:
            query, exact = both(query, need), {""}
    if whole:
        return exact, of_strings(exact)
    return None, both(query, of_strings(exact))


def node(op, value) -> tuple[set[str] | None, Query]:
    if op is K.LITERAL:
        return {chr(value).lower()}, ANY
    if op is K.IN:
        chars: set[str] = set()
        for kind, v in value:
            if kind is K.LITERAL:
                chars.add(chr(v).lower())
            elif kind is K.RANGE and v[1] - v[0] < 8:
                chars |= {chr(c).lower() for c in range(v[0], v[1] + 1)}
            else:
                return None, ANY
        return (chars, ANY) if len(chars) <= 8 else (None, ANY)
    if op is K.SUBPATTERN:
        return shape(value[-1])
    if op is K.BRANCH:
        parts = [shape(x) for x in value[1]]
        query = simplest(frozenset().union(*(q for _, q in parts)))
        if all(e is not None for e, _ in parts):
            exact = set().union(*(e for e, _ in parts))
            if len(exact) <= MOST_STRINGS:
                return exact, query
        return None, query
    if op in (K.MAX_REPEAT, K.MIN_REPEAT):
        low, high, inner = value
        exact, query = shape(inner)
        if low == 0:
            return ({"", *exact}, ANY) if high == 1 and exact is not None else (None, ANY)
        if exact is not None and low == high and len(exact) ** low <= MOST_STRINGS:
            return reduce(lambda a, b: {x + y for x in a for y in b}, [exact] * low), ANY
        if exact is not None and len(exact) == 1 and low > 1:
            return None, of_strings({next(iter(exact)) * low})
        return None, query
    return None, ANY  # anything else may match anything


def trigram_query(rule: Rule) -> Query:
    """The Boolean trigram query of a rule over lower-cased text; {{}} if no trigram is mandatory."""
    _, query = shape(parser.parse(rule.pattern))
    return ANY if frozenset() in query else query


def spans(text: Column, rule: Rule, order: int) -> Column:
    """array<struct<start, order, end, kind>> of the rule's matches, in code points, end exclusive."""
    zero = F.lit(0).cast("long")
    gaps = F.transform(F.split(text, rule.java, -1), F.length)
    sizes = F.transform(F.regexp_extract_all(text, F.lit(rule.java), F.lit(0)), F.length)
    group = F.transform(F.regexp_extract_all(text, F.lit(rule.java), F.lit(rule.group)), F.length) if rule.group else sizes
    none = F.array().cast("array<struct<start:bigint,order:int,end:bigint,kind:string>>")
    found = F.aggregate(
        F.arrays_zip(F.slice(gaps, F.lit(1), F.size(sizes)).alias("gap"), sizes.alias("own"), group.alias("group")),
        F.struct(zero.alias("at"), none.alias("out")),
        lambda s, m: F.struct(
            (s["at"] + m["gap"] + m["own"]).alias("at"),
            F.when(m["group"] >= rule.least, F.array_append(s["out"], F.struct(
                (s["at"] + m["gap"]).alias("start"), F.lit(order).alias("order"),
                (s["at"] + m["gap"] + m["own"]).alias("end"), F.lit(rule.kind).alias("kind"))))
            .otherwise(s["out"]).alias("out")),
        lambda s: s["out"])
    return F.when(F.regexp_like(text, F.lit(rule.java)), found).otherwise(none)


def candidates(docs: DataFrame, rules: tuple[Rule, ...], text: str) -> DataFrame:
    """(look, rules): for each text, by its hash, the rules whose query it satisfies, from intersected postings."""
    clauses = [(r, c, sorted(clause)) for r, rule in enumerate(rules)
               for c, clause in enumerate(sorted(trigram_query(rule), key=sorted)) if clause]
    grams = sorted({g for _, _, clause in clauses for g in clause})
    present = F.array_compact(F.array(*(F.when(F.contains("low", F.lit(g)), F.lit(i)) for i, g in enumerate(grams))))
    postings = (docs.select(F.xxhash64(F.col(text)).alias("look"), F.lower(F.col(text)).alias("low")).where("low <> ''")
                .select("look", F.explode(present).alias("gram")).distinct())
    by_gram: dict[int, list[tuple[int, int, int]]] = {}
    for r, c, clause in clauses:
        for g in clause:
            by_gram.setdefault(grams.index(g), []).append((r, c, len(clause)))
    # The ANDs that a trigram takes part in: a constant of the rules, not a table.
    uses = F.create_map(*(x for g, own in by_gram.items() for x in (
        F.lit(g), F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(c).alias("clause"), F.lit(n).alias("n")) for r, c, n in own)))))
    met = (postings.select("look", F.explode(F.element_at(uses, F.col("gram"))).alias("u")).select("look", "u.*")
           .groupBy("look", "rule", "clause", "n").agg(F.count("*").alias("have")).where(F.col("have") == F.col("n")))
    return met.groupBy("look").agg(F.collect_set("rule").alias("rules"))


def scan(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = BASE + MORE, found: str = "found") -> DataFrame:
    """Append ``found``: array<struct<start, order, end, kind>> by start, then kind as listed."""
    indexed = [i for i, r in enumerate(rules) if trigram_query(r) != ANY]
    k, t, mark = fresh_name(df, "_look"), fresh_name(df, "_text"), fresh_name(df, "_rules")
    out = df.withColumn(t, F.coalesce(F.col(text), F.lit("")))
    if indexed:
        near = Scratch(df.sparkSession, "secrets").save(candidates(df, rules, text)).select(F.col("look").alias(k), F.col("rules").alias(mark))
        few = near.limit(BROADCAST_TEXTS + 1).count() <= BROADCAST_TEXTS
        out = out.join(F.broadcast(near) if few else near, F.xxhash64(F.col(t)) == F.col(k), "left").drop(k)
    else:
        out = out.withColumn(mark, F.lit(None).cast("array<int>"))
    none = F.array().cast("array<struct<start:bigint,order:int,end:bigint,kind:string>>")
    parts = []
    for i, rule in enumerate(rules):
        own = spans(F.col(t), rule, i)
        parts.append(F.when(F.array_contains(F.col(mark), i), own).otherwise(none) if i in indexed else own)
    return with_results(out, {found: F.array_sort(F.concat(*parts))}).drop(t, mark)


def joined(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def base_only(found: Column) -> Column:
    return F.filter(found, lambda s: s["order"] < len(BASE))


def count_of(found: Column, kind: str) -> Column:
    return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("long")


def masked(text: Column, found: Column, mask: str = "[secret]") -> Column:
    """The text with every span, or run of overlapping spans, replaced by ``mask``."""
    zero = F.lit(0).cast("long")
    end = F.aggregate(
        found, F.struct(zero.alias("at"), F.lit("").alias("out")),
        lambda s, m: F.struct(
            F.greatest(s["at"], m["end"]).alias("at"),
            F.when(m["start"] < s["at"], s["out"]).otherwise(F.concat(
                s["out"], F.substring(text, (s["at"] + 1).cast("int"), (m["start"] - s["at"]).cast("int")), F.lit(mask))).alias("out")))
    rest = F.substring(text, (end["at"] + 1).cast("int"), F.char_length(text))
    return F.when(F.size(found) > 0, F.concat(end["out"], rest)).otherwise(text)
