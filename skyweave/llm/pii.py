"""Personal data: patterns, and terms that disclose what the patterns find. DataFrame operations only.

The patterns give protected entities. How strongly a term reveals an entity is their pointwise mutual information over the documents,
as a share of the information the entity itself carries: 1 means that the term occurs with the entity
alone. Terms near an entity above a threshold are generalised, above a second one removed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyweave.llm.workspace import Workspace, numbered

KINDS = ("email", "ip", "card", "phone")

# What the patterns match. Each is written so that no part is matched twice: a match starts at the start of its
# run of characters or where the last match ended, and runs are possessive, which keeps time linear and the stack flat.
_LOCAL, _HOST = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
EMAIL = rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_HOST}++(?:\.{_HOST}++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,}+"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
IP_PARTS = rf"^{_PART}(?:\.{_PART}){{3}}$"
TERM = r"[\p{L}\p{N}]++(?:['_-][\p{L}\p{N}]++)*+"


@dataclass(frozen=True)
class Disclosure:
    """Which terms near an entity are sanitised."""

    reach: int = 80
    """Characters on either side of an entity in which terms are weighed."""
    support: int = 3
    """Distinct contexts in which a term and an entity must meet. Copies of a text are one context."""
    generalise: float = 0.65
    remove: float = 0.85


PIECE = 1024
"""Code points of the pieces a text is cut into where parts of it are looked up by place."""


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def _in_blocks(items: Column) -> Column:
    """An array cut into about as many blocks as a block has items."""
    def cut(a: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(a))).cast("int")
        numbers = F.sequence(F.lit(0), F.floor((F.size(a) - 1) / width).cast("int"))
        return F.transform(numbers, lambda k: F.slice(a, k * width + 1, width))

    return F.when(F.size(items) > 0, _bound(items, cut)).otherwise(F.slice(F.array(items), 1, 0))


def _accumulated(items: Column, start: Column, empty: Column, step) -> Column:
    """The rows ``step`` makes of the items, in order: ``step(state, item)`` gives (state, rows). Rows are gathered block by block,
    so that a long array is not copied at every item."""
    def add(acc: Column, x: Column) -> Column:
        return _bound(step(acc["state"], x), lambda r: F.struct(r["state"].alias("state"), F.concat(acc["out"], r["rows"]).alias("out")))

    def add_block(acc: Column, block: Column) -> Column:
        inner = F.aggregate(block, F.struct(acc["state"].alias("state"), empty.alias("out")), add)
        return _bound(inner, lambda r: F.struct(r["state"].alias("state"), F.concat(acc["out"], r["out"]).alias("out")))

    return F.aggregate(_in_blocks(items), F.struct(start.alias("state"), empty.alias("out")), add_block, lambda acc: acc["out"])


def located(text: Column, pattern: str) -> Column:
    """All matches as array of (start, end, value): code points, end exclusive. The text between the matches gives their places."""
    parts = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def gaps(f: Column) -> Column:
        return F.zip_with(F.slice(parts, 1, F.size(f)), f, lambda p, m: F.struct(F.length(p).alias("gap"), m.alias("value")))

    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")

    def step(at: Column, x: Column) -> Column:
        start = at + x["gap"]
        end = start + F.length(x["value"])
        one = F.struct(start.alias("start"), end.alias("end"), x["value"].alias("value"))
        return F.struct(end.alias("state"), F.array(one).alias("rows"))

    return _accumulated(_bound(found, gaps), F.lit(0), empty, step)


def _pieces(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))


def _from_pieces(pieces: Column, start: Column, end: Column) -> Column:
    """The part of a text from ``start`` to ``end``, from its pieces: costs as much as the part is long, wherever it stands."""
    first = F.floor(start / PIECE).cast("int")
    count = F.floor((F.greatest(end, start + 1) - 1) / PIECE).cast("int") - first + 1
    near = F.array_join(F.slice(pieces, first + 1, count), "")
    return F.when(end > start, F.substr(near, start - first * PIECE + 1, end - start)).otherwise("")


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    digits = F.reverse(_digits(value))

    def add(total: Column, i: Column) -> Column:
        d = F.substr(digits, i, F.lit(1)).cast("int")
        double = d * 2 - F.when(d > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 0, double).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def base_spans(text: Column) -> Column:
    """Array of (kind, start, end, value): by kind as listed, then by start. Null text: empty."""
    valid = {
        "email": lambda m: F.lit(True),
        "ip": lambda m: m["value"].rlike(IP_PARTS),
        "card": lambda m: F.length(_digits(m["value"])).between(13, 19) & _luhn(m["value"]),
        "phone": lambda m: F.length(_digits(m["value"])).between(9, 15),
    }
    possible = {
        "email": text.contains("@"),
        "ip": text.rlike(r"[0-9]\.[0-9]"),
        "card": text.rlike(r"[0-9](?:[ -]?[0-9]){12}"),
        "phone": text.contains("+"),
    }
    none = F.array().cast("array<struct<kind:string,start:int,end:int,value:string>>")

    def of(kind: str, pattern: str) -> Column:
        named = F.transform(
            F.filter(located(text, pattern), valid[kind]),
            lambda m: F.struct(F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end"), m["value"].alias("value")),
        )
        return F.when(possible[kind], named).otherwise(none)

    return F.concat(*[of(k, p) for k, p in zip(KINDS, (EMAIL, IP, CARD, PHONE))])


def _near(text: Column, spans: Column, how: Disclosure) -> Column:
    """The terms around each span, as array of (entity, context, term, start, end); terms that touch a span are left out."""

    def around(span: Column, pieces: Column, blocks: Column, size: Column) -> Column:
        low = F.greatest(span["start"] - how.reach, F.lit(0))
        high = F.least(span["end"] + how.reach, size)
        before = _from_pieces(pieces, low, span["start"])
        before = F.when(low > 0, F.regexp_replace(before, r"^[\p{L}\p{N}]+", "")).otherwise(before)
        after = _from_pieces(pieces, span["end"], high)
        after = F.when(high >= size, after).otherwise(F.regexp_replace(after, r"[\p{L}\p{N}]+$", ""))
        entity = F.xxhash64(span["kind"], F.lower(span["value"]))
        beside = F.flatten(
            F.transform(
                F.filter(blocks, lambda b: (b["low"] < high) & (b["high"] > low)),
                lambda b: F.filter(b["spans"], lambda s: (s["start"] < high) & (s["end"] > low)),
            )
        )

        def terms(sides: Column) -> Column:
            context = F.xxhash64(sides["before"], sides["after"])

            def of(part: Column, shift: Column) -> Column:
                return F.transform(
                    F.filter(located(part, TERM), lambda m: F.length(m["value"]) >= 3),
                    lambda m: F.struct(
                        entity.alias("entity"), context.alias("context"), F.lower(m["value"]).alias("term"),
                        (m["start"] + shift).alias("start"), (m["end"] + shift).alias("end"),
                    ),
                )

            found = F.concat(of(sides["before"], span["start"] - F.length(sides["before"])), of(sides["after"], span["end"]))
            free = lambda t: ~F.exists(sides["beside"], lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"]))
            return F.filter(found, free)

        return _bound(F.struct(before.alias("before"), after.alias("after"), beside.alias("beside")), terms)

    def block(spans_of: Column) -> Column:
        return F.struct(
            spans_of[0]["start"].alias("low"), F.array_max(F.transform(spans_of, lambda s: s["end"])).alias("high"), spans_of.alias("spans")
        )

    # Spans in the order of their places, in blocks with their range, so that those beside a place are found without meeting all.
    placed = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    given = F.struct(_pieces(text).alias("pieces"), F.transform(_in_blocks(placed), block).alias("blocks"), F.length(text).alias("size"))
    every = _bound(given, lambda g: F.flatten(F.transform(spans, lambda s: around(s, g["pieces"], g["blocks"], g["size"]))))
    return F.when(F.size(spans) > 0, every)


def found_in(docs: DataFrame, workspace: Workspace, how: Disclosure, kept_cols: list[str] = ()) -> DataFrame:
    """A numbered row per row of ``docs``: doc_id, base spans, the terms near them, and ``kept_cols`` under ``in_``; written."""
    text = F.coalesce("text", F.lit(""))
    extra = [F.col(f"`{c}`").alias(f"in_{c}") for c in kept_cols]
    rows = docs.select("doc_id", text.alias("body"), *extra).withColumn("base", base_spans(F.col("body")))
    rows = rows.withColumn("near", _near(F.col("body"), F.col("base"), how)).drop("body")
    return workspace.keep(numbered(rows), "found")


def disclosing(rows: DataFrame, docs: DataFrame, workspace: Workspace, how: Disclosure) -> DataFrame:
    """``entity``, ``term``, ``disclosure`` of all pairs with enough support above the lower threshold.

    All counts are numbers of documents: those with the term from the whole corpus, those with the entity, and those with
    the term within reach of the entity. Everything is aggregated before it is shuffled.
    """
    met = rows.select("row_id", F.explode("near").alias("x")).select("row_id", "x.entity", "x.context", "x.term")
    support = (
        met.groupBy("entity", "term", "context").agg(F.lit(1).alias("one"))
        .groupBy("entity", "term").agg(F.count("*").alias("contexts")).where(F.col("contexts") >= how.support)
        .select("entity", "term")
    )
    support = workspace.keep(support, "support")
    together = (
        met.join(support, ["entity", "term"])
        .groupBy("entity", "term", "row_id").agg(F.lit(1).alias("one"))
        .groupBy("entity", "term").agg(F.count("*").alias("n_both"))
    )
    entities = (
        rows.select("row_id", F.explode("base").alias("s"))
        .groupBy(F.xxhash64("s.kind", F.lower("s.value")).alias("entity"), "row_id").agg(F.lit(1).alias("one"))
        .groupBy("entity").agg(F.count("*").alias("n_entity"))
    )
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(TERM), F.lit(0)))
    terms = docs.select(F.explode(words).alias("term")).groupBy("term").agg(F.count("*").alias("n_term"))
    total = F.lit(float(rows.count()))
    information = F.log(total / F.col("n_entity"))
    mutual = F.log(total * F.col("n_both") / (F.col("n_entity") * F.col("n_term")))
    scored = (
        together.join(entities, "entity")
        .join(terms, "term")
        .withColumn("disclosure", F.when(information > 0, mutual / information))
    )
    return workspace.keep(
        scored.where(F.col("disclosure") >= how.generalise).select("entity", "term", "disclosure"), "disclosing"
    )


def term_spans(rows: DataFrame, disclosed: DataFrame, how: Disclosure) -> DataFrame:
    """``row_id`` and its ``terms``: array of (start, end, remove), by start."""
    near = rows.select("row_id", F.explode("near").alias("x")).select("row_id", "x.entity", "x.term", "x.start", "x.end")
    return (
        near.join(disclosed, ["entity", "term"])
        .groupBy("row_id", "start", "end")
        .agg(F.max("disclosure").alias("disclosure"))
        .groupBy("row_id")
        .agg(F.array_sort(F.collect_list(F.struct("start", "end", (F.col("disclosure") >= how.remove).alias("remove")))).alias("terms"))
    )


def spans_text(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def personal_data(docs: DataFrame, workspace: Workspace, how: Disclosure = Disclosure(), kept_cols: list[str] = ()) -> DataFrame:
    """A row per row of ``docs`` (``doc_id``, ``text``): doc_id, ``base`` spans (kind, start, end, value), ``terms`` (start, end,
    remove), and ``kept_cols`` under the prefix ``in_``.

    Null and empty texts have no spans. Repeated rows are documents of their own and get the same spans. Null ids stay null,
    an empty table gives an empty result. Very long texts are matched whole; the work on a text grows with its length and, for n matches,
    with n times the root of n.
    """
    rows = found_in(docs, workspace, how, kept_cols)
    disclosed = disclosing(rows, docs, workspace, how)
    # Written, so that Spark knows how short the list is before it decides how to join it to the texts.
    terms = workspace.keep(term_spans(rows, disclosed, how), "terms")
    none = F.array().cast("array<struct<start:int,end:int,remove:boolean>>")
    return (
        rows.drop("near")
        .join(terms, "row_id", "left")
        .withColumn("terms", F.coalesce("terms", none))
        .select("doc_id", "base", "terms", *[f"in_{c}" for c in kept_cols])
    )


def sanitised(text: Column, base: Column, terms: Column) -> Column:
    """``text`` with base spans replaced by their kind, disclosing terms by what they look like, or removed. Spans
    that overlap are replaced as one, by the sign of the one that starts first, or of the longer of two that start together."""
    def ordered(s: Column, sign: Column) -> Column:
        return F.struct(s["start"].alias("start"), (-s["end"]).alias("before"), s["end"].alias("end"), sign.alias("sign"))

    named = F.transform(base, lambda s: ordered(s, F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))))

    def sign(t: Column) -> Column:
        value = F.substr(text, t["start"] + 1, t["end"] - t["start"])
        kind = F.when(value.rlike("[0-9]"), "[NUMBER]").when(value.rlike(r"^\p{Lu}"), "[NAME]").otherwise("[TERM]")
        return ordered(t, F.when(t["remove"], "").otherwise(kind))

    spans = F.array_sort(F.concat(named, F.transform(terms, sign)))
    none = F.array().cast("array<struct<start:int,end:int,sign:string>>")

    def one(s: Column) -> Column:
        return F.struct(s["start"].alias("start"), s["end"].alias("end"), s["sign"].alias("sign"))

    def step(held: Column, s: Column) -> Column:
        # The span before is done once one begins behind its end; until then it grows.
        apart = s["start"] >= held["end"]
        longer = F.struct(held["start"].alias("start"), F.greatest(held["end"], s["end"]).alias("end"), held["sign"].alias("sign"))
        return F.struct(F.when(apart, one(s)).otherwise(longer).alias("state"), F.when(apart, F.array(held)).otherwise(none).alias("rows"))

    def rebuilt(merged: Column, pieces: Column) -> Column:
        def part(m: Column, i: Column) -> Column:
            return F.concat(_from_pieces(pieces, F.when(i > 0, F.get(merged, i - 1)["end"]).otherwise(0), m["start"]), m["sign"])

        return F.array_join(F.transform(merged, part), "")

    # A span of no width behind the end closes the last one.
    begin = F.struct(F.lit(0).alias("start"), F.lit(0).alias("end"), F.lit("").alias("sign"))
    last = F.struct(F.length(text).alias("start"), (-F.length(text)).alias("before"), F.length(text).alias("end"), F.lit("").alias("sign"))
    closed = F.concat(spans, F.array(last, last))
    given = F.struct(_accumulated(closed, begin, none, step).alias("merged"), _pieces(text).alias("pieces"))
    return F.when(F.size(spans) > 0, _bound(given, lambda g: rebuilt(g["merged"], g["pieces"]))).otherwise(text)
