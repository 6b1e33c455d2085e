"""Personal data by pattern, and terms that give protected entities away.

Base spans: e-mail addresses, IP addresses, card numbers (Luhn) and phone
numbers, leftmost and non-overlapping per kind; spans count code points.
Patterns are written so that no position is tried twice (a match can only
start where a run of its first characters starts or the last match ended)
and repeated groups do not recurse.

Information-theoretic sanitisation: every value found is a protected entity
c.  Terms t of at least ``MIN_TERM`` characters in the ``CONTEXT``
characters around its occurrences co-occur with it.  Over the distinct
texts of the corpus,

    disclosure(c; t) = PMI(c; t) / IC(c)
                     = log(n(c,t) * N / (n(c) * n(t))) / log(N / n(c))

is the share of the entity's information that the term gives away.  Pairs
seen in fewer than ``MIN_TEXTS`` distinct texts say nothing.  In texts that
hold the entity, every occurrence of a term whose disclosure reaches
``REMOVE`` is removed, from ``GENERALISE`` on it is generalised.

Only DataFrame functions are used.  The corpus is read once for spans and
contexts, once to count the candidate terms, and the texts with disclosing
terms once more; what is shuffled are hashes, entities and terms.

Defined cases: a null text is empty; repeated rows get equal spans; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, text_of, with_defaults, written

LOCAL = "[A-Za-z0-9._%+-]"
PART = "0*(?:[01]?[0-9]?[0-9]|2[0-4][0-9]|25[0-5])"
#: kind, characters one of which a text must have, pattern
KINDS = (
    ("email", "@", f"(?:\\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++"),
    ("ip", ".", "(?:\\G|(?<![0-9]))[0-9]++\\.[0-9]++\\.[0-9]++\\.[0-9]++"),
    ("card", "", "(?:\\G|(?<![0-9]))[0-9](?:[\\x20-]?[0-9])++"),
    ("phone", "+", "\\+[0-9][\\x20().0-9-]+[0-9]"),
)
TERM_KINDS = ("generalise", "remove")
MARKS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "generalise": "[TERM]", "remove": ""}

NO_TERM = "[^\\p{L}\\p{N}]+"
TERM = "[\\p{L}\\p{N}]+"
MIN_TERM = 3
CONTEXT = 120
MIN_TEXTS = 3
GENERALISE, REMOVE = 0.5, 0.8

SPANS = "array<struct<kind:string,start:int,end:int,value:string>>"


def _sum(x: Column) -> Column:
    return F.aggregate(x, F.lit(0), lambda a, v: a + v)


def _before(x: Column, block: int = 128) -> Column:
    """For each element of an int array the sum of those before it, by sums
    of blocks (linear but for the few blocks)."""
    size = F.size(x)
    sums = F.transform(F.sequence(F.lit(0), F.floor((size - 1) / block).cast("int")),
                       lambda b: _sum(F.slice(x, b * block + 1, F.lit(block))))
    start = F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("all"))
    tops = F.aggregate(sums, start, lambda a, s: F.struct(
        (a["sum"] + s).alias("sum"), F.concat(a["all"], F.array(a["sum"])).alias("all")), lambda a: a["all"])

    def place(tops: Column) -> Column:
        block_of = lambda i: F.floor(i / block).cast("int")
        return F.transform(x, lambda _, i: F.get(tops, block_of(i)) + _sum(F.slice(x, block_of(i) * block + 1, i % block)))

    return let(tops, place)


def _matches(text: Column, pattern: str, kind: str) -> Column:
    """All matches of ``pattern`` as spans: what lies between matches and the
    matches themselves add up to positions."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def spans(found: Column) -> Column:
        between = F.split(text, pattern, -1)
        sizes = F.transform(found, lambda m, i: F.char_length(F.get(between, i)) + F.char_length(m))
        ends = let(sizes, lambda s: F.zip_with(_before(s), s, lambda b, n: b + n))
        return F.zip_with(ends, found, lambda e, m: F.struct(
            F.lit(kind).alias("kind"), (e - F.char_length(m)).alias("start"), e.alias("end"), m.alias("value")))

    none = F.array().cast(SPANS)
    return let(found, lambda x: F.when(F.size(x) == 0, none).otherwise(spans(x)))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    doubled = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(
        i % 2 == 0, d.cast("int")).otherwise(2 * d.cast("int") - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return _sum(doubled) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(f"^{PART}(?:\\.{PART}){{3}}$")
    if kind == "card":
        n = F.char_length(_digits(value))
        return F.when((n >= 13) & (n <= 19), _luhn(_digits(value))).otherwise(False)
    if kind == "phone":
        return F.char_length(_digits(value)).between(9, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """The valid base spans of a text, by kind as listed, then start."""
    parts = []
    for kind, needed, pattern in KINDS:
        spans = F.filter(_matches(text, pattern, kind), lambda s: _valid(kind, s["value"]))  # noqa: B023
        parts.append(F.when(F.contains(text, F.lit(needed)), spans).otherwise(F.array().cast(SPANS)))
    return F.concat(*parts)


def _terms(text: Column) -> Column:
    return F.filter(F.array_distinct(F.split(F.lower(text), NO_TERM)), lambda t: (F.char_length(t) >= MIN_TERM) & t.rlike("\\p{L}"))


def _contexts(text: Column, spans: Column) -> Column:
    """Per span its entity and the terms around it; words cut by the edge of
    the context are left out."""
    def around(s: Column) -> Column:
        low = F.greatest(s["start"] - CONTEXT, F.lit(0))
        before = F.regexp_replace(F.substring(text, low + 1, s["start"] - low), f"{TERM}$", "")
        before = F.when(low > 0, F.regexp_replace(before, f"^{TERM}", "")).otherwise(before)
        after = F.substring(text, s["end"] + 1, F.lit(CONTEXT))
        after = F.when(F.char_length(after) == CONTEXT, F.regexp_replace(after, f"{TERM}$", "")).otherwise(after)
        after = F.regexp_replace(after, f"^{TERM}", "")
        return F.struct(F.concat_ws(":", s["kind"], F.lower(s["value"])).alias("entity"),
                        _terms(F.concat_ws(" ", before, after)).alias("terms"))
    return F.transform(spans, around)


def _rows(docs: DataFrame) -> DataFrame:
    return (with_defaults(docs, doc_id="bigint", text="string").select("doc_id", text_of().alias("text"))
            .withColumn("key", F.md5("text")))


def found_spans(docs: DataFrame) -> DataFrame:
    """doc_id, key (of the text), base spans and their contexts, written."""
    rows = _rows(docs).withColumn("spans", base_spans(F.col("text")))
    return written(rows.select("doc_id", "key", "spans", F.when(
        F.size("spans") > 0, _contexts(F.col("text"), F.col("spans"))).alias("contexts")), "pii-spans")


def disclosures(docs: DataFrame, found: DataFrame) -> DataFrame:
    """entity, term, disclosure of every pair that reaches ``GENERALISE``."""
    seen = found.select("key", F.explode("contexts").alias("c")).select("key", "c.entity", "c.terms")
    texts = found.agg(F.countDistinct("key")).first()[0]
    entities = seen.select("key", "entity").distinct().groupBy("entity").agg(F.count("*").alias("n_c"))
    pairs = (seen.select("key", "entity", F.explode("terms").alias("term")).distinct()
             .groupBy("entity", "term").agg(F.count("*").alias("n_ct")).where(F.col("n_ct") >= MIN_TEXTS))
    pairs = written(pairs.join(entities, "entity"), "pii-pairs")
    wanted = written(pairs.select("term").distinct(), "pii-terms")
    counts = (_rows(docs).select(F.xxhash64("key").alias("key"), F.explode(_terms(F.col("text"))).alias("term"))
              .join(wanted, "term").distinct().groupBy("term").agg(F.count("*").alias("n_t")))
    n = F.lit(float(texts or 0))
    share = F.log(F.col("n_ct") * n / (F.col("n_c") * F.col("n_t"))) / F.log(n / F.col("n_c"))
    return (pairs.join(counts, "term")
            .withColumn("disclosure", F.when(F.col("n_c") < n, share).otherwise(0.0))
            .where(F.col("disclosure") >= GENERALISE).select("entity", "term", "disclosure"))


def _term_spans(docs: DataFrame, found: DataFrame, disclosing: DataFrame) -> DataFrame:
    """key and term spans of every text with disclosing terms."""
    held = found.select("key", "spans", F.explode(F.array_distinct(F.col("contexts.entity"))).alias("entity")).dropDuplicates(["key", "entity"])
    strongest = (held.join(disclosing, "entity").groupBy("key", "term").agg(F.max("disclosure").alias("disclosure")))
    per_text = written(strongest.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct(
        "term", F.when(F.col("disclosure") >= REMOVE, TERM_KINDS[1]).otherwise(TERM_KINDS[0])))).alias("actions")), "pii-actions")
    texts = _rows(docs).select("key", "text").join(per_text.hint("shuffle_hash"), "key").dropDuplicates(["key"])
    texts = texts.join(found.select("key", "spans").dropDuplicates(["key"]), "key")
    words = _matches(F.col("text"), TERM, "term")
    named = F.transform(words, lambda w: F.struct(
        F.element_at("actions", F.lower(w["value"])).alias("kind"), w["start"].alias("start"), w["end"].alias("end"), w["value"].alias("value")))
    clear = lambda w: ~F.exists("spans", lambda s: (s["start"] < w["end"]) & (s["end"] > w["start"]))
    return texts.select("key", F.filter(named, lambda w: w["kind"].isNotNull() & clear(w)).alias("terms"))


def _of_kind(spans: str, kind: str) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


def spans_of(docs: DataFrame) -> DataFrame:
    """doc_id, key, ``spans`` (base) and ``all_spans`` (with term spans) of every row."""
    found = found_spans(docs)
    terms = written(_term_spans(docs, found, disclosures(docs, found)), "pii-term-spans")
    terms = terms.select(F.col("key").alias("t_key"), "terms")
    of_kind = [_of_kind("terms", k) for k in TERM_KINDS]
    every = F.when(F.col("terms").isNull(), F.col("spans")).otherwise(F.concat("spans", *of_kind))
    return (found.join(terms, found.key == terms.t_key, "left")
            .select("doc_id", "key", "spans", every.alias("all_spans")))


def _joined(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digests(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, counts of base spans, their digest, and all spans."""
    count = lambda k: F.size(_of_kind("spans", k)).cast("bigint").alias(f"n_{k}")
    return spans_of(docs).select("doc_id", *[count(k) for k, _, _ in KINDS],
                                 F.sha2(_joined("spans"), 256).alias("base_sha256"), _joined("all_spans").alias("spans"))


def sanitised(docs: DataFrame) -> DataFrame:
    """Per row: doc_id and the text with every span replaced by its mark;
    overlapping spans are replaced together, by the first one's mark."""
    spans = spans_of(docs).select("key", "all_spans").dropDuplicates(["key"]).where(F.size("all_spans") > 0)
    rows = _rows(docs).join(spans, "key", "left")
    ordered = F.array_sort(F.transform("all_spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    empty = F.array().cast("array<struct<start:int,end:int,kind:string>>")

    def merge(a: Column, s: Column) -> Column:
        last = F.element_at(a, -1)
        joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"), last["kind"].alias("kind"))
        return (F.when((F.size(a) > 0) & (F.try_element_at(a, F.lit(-1))["end"] > s["start"]),
                       F.concat(F.slice(a, 1, F.size(a) - 1), F.array(joined))).otherwise(F.concat(a, F.array(s))))

    mark = F.create_map(*[F.lit(x) for kv in MARKS.items() for x in kv])
    merged = F.aggregate(ordered, empty, merge)
    whole = let(merged, lambda m: F.concat(
        F.array_join(F.transform(m, lambda s, i: F.concat(
            F.substring(F.col("text"), F.coalesce(F.get(m, i - 1)["end"], F.lit(0)) + 1, s["start"] - F.coalesce(F.get(m, i - 1)["end"], F.lit(0))),
            F.element_at(mark, s["kind"]))), ""),
        F.substring(F.col("text"), F.element_at(m, -1)["end"] + 1, F.char_length("text"))))
    return rows.select("doc_id", F.when(F.col("all_spans").isNull(), F.col("text")).otherwise(whole).alias("text"))
