"""How far the sources of a language differ in their words, from wide term vectors.

Occurrences are counted by language, source and term where the texts are and summed after
the shuffle, so only vocabularies move. Each kept term of a language becomes one array
with a place for every source of that language, and higher-order functions turn it into
contributions of pairs of sources, which partial aggregation sums where they are made.
A pair in which the term occurs on neither side contributes the same for every such term,
so that part is a product and is not emitted. All numbers are whole: results do not
depend on order.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import settle

LEAST_DOCUMENTS = 10
UNITS = 1_000_000_000
MOST_TERMS = 10
#: Bytes of text whose terms a task counts before it sends them on, a longer text at once.
HELD_BYTES = 1 << 24

#: Bytes of texts to bytes of terms: A to Z become small letters, all else below 0x80 but letters a space.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def _sent(n: dict, d: dict) -> Iterator[pa.RecordBatch]:
    for (lang, source), counts in n.items():
        columns = [
            pa.repeat(pa.scalar(lang, pa.string()), len(counts)), pa.repeat(pa.scalar(source, pa.string()), len(counts)),
            pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64()),
            pa.array([d[lang, source][t] for t in counts], pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "d"])


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences, some texts at a time; a term is a run of bytes, so UTF-8 is never decoded."""
    n, d, held = defaultdict(Counter), defaultdict(Counter), 0
    for batch in batches:
        for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text"))):
            terms = text.translate(_FOLD).split()
            n[lang, source].update(terms)
            d[lang, source].update(set(terms))
            held += len(text)
            if held >= HELD_BYTES:
                yield from _sent(n, d)
                n, d, held = defaultdict(Counter), defaultdict(Counter), 0
    yield from _sent(n, d)


def occurrences(docs: DataFrame, *, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, term): n occurrences, d documents that hold the term."""
    filled = (F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in (lang, source, text))
    rows = docs.select(*(c.alias(name) for c, name in zip(filled, ("lang", "source", "text"))))
    rows = rows.withColumn("text", F.col("text").cast("binary"))
    counted = rows.mapInArrow(_counts, "lang string, source string, term binary, n long, d long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))


def share(count: Column, mass: Column) -> Column:
    """p = 1 + floor(10^9 (count + 2) / mass) as long; the product may pass 2^63, so it is a decimal."""
    scaled = (count + 2).cast("decimal(28,0)") * F.lit(UNITS).cast("decimal(10,0)")
    return F.call_function("div", scaled, mass.cast("decimal(28,0)")) + 1


def distance(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)); shares are at most 10^9 + 1, so longs hold it."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def term_vectors(docs: DataFrame, *, least_documents: int = LEAST_DOCUMENTS, text: str = "text", lang: str = "lang", source: str = "source") -> tuple[DataFrame, DataFrame]:
    """The wide vectors (lang, term, c, p), and per language its sources and their masses.

    In a vector ``c`` has a count and ``p`` a share for each source of the language. The second
    table has a row a language: ``sources`` in the order of the vectors' places, ``mass``
    (occurrences of kept terms in the source, plus twice the kept terms), ``apart`` (a row of
    distances a place: of the shares of a term that both sources lack), ``whole`` (the
    language's own mass) and ``v``, the number of kept terms.
    """
    blank = F.lit("")
    groups = docs.select(F.coalesce(F.col(f"`{lang}`"), blank).alias("lang"), F.coalesce(F.col(f"`{source}`"), blank).alias("source")).distinct()
    counted = occurrences(docs, text=text, lang=lang, source=source)
    by_term = counted.groupBy("lang", "term").agg(F.map_from_entries(F.collect_list(F.struct("source", "n"))).alias("by_source"), F.sum("d").alias("d"))
    kept = settle(by_term.where(F.col("d") >= least_documents).select("lang", F.col("term").cast("string").alias("term"), "by_source"), "kept-terms")
    sums = kept.select("lang", F.explode("by_source").alias("source", "n")).groupBy("lang", "source").agg(F.sum("n").alias("n"))
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    named = groups.join(sums, ["lang", "source"], "left").join(sizes, "lang", "left")
    named = named.select("lang", "source", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("v", F.lit(0)).alias("v"))
    mass = F.col("n") + 2 * F.col("v")
    zero = F.when(mass > 0, share(F.lit(0), F.greatest(mass, F.lit(1))))
    ordered = F.array_sort(F.collect_list(F.struct("source", mass.alias("mass"), zero.alias("zero"))))
    by_lang = named.groupBy("lang").agg(ordered.alias("s"), F.max("v").alias("v"), F.sum("n").alias("n")).select(
        "lang", F.col("s.source").alias("sources"), F.col("s.mass").alias("mass"), F.col("s.zero").alias("zero"), "v",
        (F.col("n") + 2 * F.col("v")).alias("whole"),
    )
    apart = F.transform("zero", lambda p: F.transform("zero", lambda q: F.when(F.col("v") > 0, distance(p, q)).otherwise(0)))
    # a row a language, written so that the planner knows its size
    langs = settle(by_lang.select("lang", "sources", "mass", apart.alias("apart"), "whole", "v"), "languages")
    wide = F.transform("sources", lambda s: F.coalesce(F.try_element_at("by_source", s), F.lit(0)))
    vectors = kept.join(langs, "lang").select("lang", "term", wide.alias("c"), "sources", "mass", "apart", "whole")
    return vectors.withColumn("p", F.zip_with("c", "mass", share)), langs


def _pairs(vectors: DataFrame, langs: DataFrame) -> DataFrame:
    """(lang, i, j, value) for every pair of places i < j of a language."""
    last = F.size("c") - 1

    def row(i: Column) -> Column:
        """What the pairs of place i with later ones have more than a term that both lack; 0 where both lack it."""
        p, bare, own = F.get("p", i), F.get("apart", i), F.get("c", i) > 0
        more = lambda j: F.when(own | (F.get("c", j) > 0), distance(p, F.get("p", j)) - F.get(bare, j)).otherwise(0)
        return F.transform(F.sequence(i + 1, last), more)

    rows = F.transform(F.sequence(F.lit(0), last - 1), row)
    spread = vectors.where(F.size("c") > 1).select("lang", "c", "p", "apart").select("lang", F.posexplode(F.flatten(rows)).alias("pair", "more"))
    summed = spread.where("more <> 0").groupBy("lang", "pair").agg(F.sum("more").alias("more"))
    ends = F.size("sources") - 1
    places = F.flatten(F.transform(F.sequence(F.lit(0), ends - 1), lambda i: F.transform(
        F.sequence(i + 1, ends), lambda j: F.struct(i.alias("i"), j.alias("j"), (F.col("v") * F.get(F.get("apart", i), j)).alias("bare"))
    )))
    numbered = langs.where(ends > 0).select("lang", F.posexplode(places).alias("pair", "place")).select("lang", "pair", "place.*")
    return numbered.join(summed, ["lang", "pair"], "left").select("lang", "i", "j", (F.col("bare") + F.coalesce("more", F.lit(0))).alias("value"))


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", F.col("value").cast("long").alias("value"), F.row_number().over(order).alias("rank"))


def audit(
    docs: DataFrame, *, least_documents: int = LEAST_DOCUMENTS, most_terms: int = MOST_TERMS,
    text: str = "text", lang: str = "lang", source: str = "source",
) -> DataFrame:
    """lang, source, part, item, value, rank: what sets each source of a language apart.

    Part ``pair`` gives the distance to every other source of the language, part ``term`` the
    ``most_terms`` terms that the source uses above the language's rate and that differ most.

    Null texts, languages and sources count as ''. Terms are runs of A to Z, a to z and whatever
    is not ASCII, only A to Z lower-cased; a language keeps those in ``least_documents`` of its
    documents, repeated rows each for themselves. Ties rank by the item's UTF-8 bytes. A
    language of one source has no pairs; one without kept terms has pairs of value 0.
    Ids and other columns are not read; an empty table gives an empty result.

    A language's arrays grow with its sources, and pairs with their square, as the
    result does; neither grows with documents.
    """
    vectors, langs = term_vectors(docs, least_documents=least_documents, text=text, lang=lang, source=source)
    pairs = _pairs(vectors, langs).join(langs.select("lang", "sources"), "lang")
    first, second = F.get("sources", F.col("i")), F.get("sources", F.col("j"))
    both = F.array(F.struct(first.alias("source"), second.alias("item")), F.struct(second.alias("source"), first.alias("item")))
    apart = pairs.select("lang", "value", F.inline(both))
    count = F.aggregate("c", F.lit(0).cast("long"), lambda s, n: s + n)
    terms = vectors.select("lang", F.col("term").alias("item"), "sources", "c", "p", share(count, F.col("whole")).alias("q"))
    # a source's own shares above the language's, before a row is made of them
    above = F.filter(F.arrays_zip("sources", "c", "p"), lambda x: (x["c"] > 0) & (x["p"] > F.col("q")))
    telling = terms.select("lang", "item", "q", F.inline(above)).select(
        "lang", F.col("sources").alias("source"), "item", distance(F.col("p"), F.col("q")).alias("value")
    )
    return _ranked(apart, "pair").unionByName(_ranked(telling, "term").where(F.col("rank") <= most_terms))
