"""Near-duplicate documents by SimHash and deletion-variant signatures."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rookery.llm.components import components
from rookery.llm.tables import map_batches, quoted, row_of, staged, utf8, with_row

SHINGLE_WORDS = 3
SEED = 42
HALF_BITS = 32
#: Links reach this far; two halves then always have one that differs by at most one bit.
MAX_DISTANCE = 2
#: A bucket of more fingerprints is not compared pair by pair but split further.
PAIRED_BUCKET = 32
#: Shingle hashes whose bits are counted at once.
BLOCK_HASHES = 1 << 14


def fingerprint(data: bytes) -> int:
    """64-bit SimHash of a text over its shingles of three words, repeats included.

    Fewer words are one shingle; no word gives zero.
    """
    words = data.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.append(0, ends)[: max(len(words) - SHINGLE_WORDS + 1, 1)].tolist()
    stops = (ends[SHINGLE_WORDS - 1 :] - 1 if len(words) >= SHINGLE_WORDS else ends[-1:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for k in range(0, len(starts), BLOCK_HASHES):
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts[k : k + BLOCK_HASHES], stops[k : k + BLOCK_HASHES])]
        packed = np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(packed, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * counts > len(starts)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, keep: tuple[str, ...], text_column: str = "text") -> DataFrame:
    """row (the columns of ``keep``) and fingerprint (as a signed long); null text counts as empty."""

    def run(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
        found = np.fromiter(map(fingerprint, utf8(batch.column(1))), np.uint64, batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["row", "fingerprint"])

    carried = docs.select(row_of(docs, keep), F.col(quoted(text_column)).alias("text"))
    return map_batches(carried, run, with_row(carried, "fingerprint long"))


def _half(value: Column, place: Column) -> Column:
    """Half 0 or 1 of a fingerprint, as a long below 2^32."""
    return F.when(place == 0, F.shiftrightunsigned(value, 32)).otherwise(value.bitwiseAND((1 << 32) - 1))


def _without(value: Column, bit: Column) -> Column:
    """A value with one bit replaced by the wildcard (cleared)."""
    return value.bitwiseAND(F.bitwise_not(F.call_function("shiftleft", F.lit(1).cast("long"), bit)))


def one_wildcard_variants(prints: DataFrame) -> DataFrame:
    """key, fingerprint: each half of each fingerprint with each of its bits deleted in turn.

    A key holds the half's place, the deleted bit and the other 31 bits.  Two
    halves share a key exactly if they are equal (then all 32) or differ in one bit (then one).
    """
    numbered = prints.select(
        "fingerprint", F.explode(F.sequence(F.lit(0), F.lit(2 * HALF_BITS - 1))).alias("_n")
    )
    place, bit = F.floor(F.col("_n") / HALF_BITS), F.col("_n") % HALF_BITS
    masked = _without(_half(F.col("fingerprint"), place), bit.cast("int"))
    return numbered.select((F.col("_n").cast("long") * (1 << HALF_BITS) + masked).alias("key"), "fingerprint")


def fingerprint_links(prints: DataFrame, paired_bucket: int = PAIRED_BUCKET) -> DataFrame:
    """Links a, b that connect exactly the distinct fingerprints within two bits of each other.

    Every pair within two bits shares a key of :func:`one_wildcard_variants`.
    Keys held by two fingerprints give the pair at once, from an aggregate.
    Small buckets are joined with themselves on the key and verified.  Larger
    ones are cut by the other half as well: with one of its bits deleted or,
    for members with equal halves, with two.  What shares such a part differs
    in at most the two deleted bits, so a part has at most four members, all
    linked; and every pair of the bucket within two bits shares a part.  Work
    is in proportion to the members of a bucket, at any size.
    """
    variants = staged(one_wildcard_variants(prints), "variants")
    buckets = staged(
        variants.groupBy("key")
        .agg(F.count(F.lit(1)).alias("n"), F.min("fingerprint").alias("a"), F.max("fingerprint").alias("b"))
        .filter("n > 1"),
        "buckets",
    )
    twos = buckets.filter("n = 2").select("a", "b").filter(_near("a", "b"))
    # These keys grow with the corpus: never broadcast, the same plan at any size.
    larger = buckets.filter("n > 2").select(F.col("key").alias("_key"), "n").hint("merge")
    shared = variants.join(larger, F.col("key") == F.col("_key")).select("key", "n", "fingerprint")
    shared = staged(shared, "shared-variants")
    few = shared.filter(F.col("n") <= paired_bucket)
    right = few.select(F.col("key").alias("_key"), F.col("fingerprint").alias("b"))
    paired = few.withColumnRenamed("fingerprint", "a").join(
        right, (F.col("key") == F.col("_key")) & (F.col("a") < F.col("b")) & _near("a", "b")
    )
    parts = _bucket_parts(shared.filter(F.col("n") > paired_bucket))
    stars = (
        parts.groupBy("key", "cut", "rest", "whole")
        .agg(F.sort_array(F.collect_set("fingerprint")).alias("members"))
        .filter(F.size("members") > 1)
        .select(F.element_at("members", 1).alias("a"), F.explode(F.slice("members", 2, 3)).alias("b"))
    )
    return twos.union(paired.select("a", "b")).union(stars).distinct()


def _near(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= MAX_DISTANCE


def _bucket_parts(members: DataFrame) -> DataFrame:
    """Each member of a bucket with one bit of its other half deleted, or two where the first half is equal too."""
    last = HALF_BITS - 1
    ones = F.expr(f"transform(sequence(0, {last}), i -> struct(i as i, i as j))")
    twos = F.expr(
        f"flatten(transform(sequence(0, {last - 1}), i -> transform(sequence(i + 1, {last}), j -> struct(i as i, j as j))))"
    )
    number = F.floor(F.col("key") / (1 << HALF_BITS))
    place, bit = F.floor(number / HALF_BITS), number % HALF_BITS
    cut = members.select(
        "key",
        "fingerprint",
        _half(F.col("fingerprint"), place).alias("half"),
        _half(F.col("fingerprint"), 1 - place).alias("other"),
        # Equal halves share all their keys: the key of bit 0 is enough for them.
        F.explode(F.when(bit == 0, F.concat(ones, twos)).otherwise(ones)).alias("cut"),
    )
    rest = _without(_without(F.col("other"), F.col("cut.i")), F.col("cut.j"))
    whole = F.when(F.col("cut.i") != F.col("cut.j"), F.col("half"))
    return cut.select("key", "fingerprint", "cut", rest.alias("rest"), whole.alias("whole"))


def _classes(prints: DataFrame, paired_bucket: int) -> DataFrame:
    """fingerprint, name: what names its component, the smallest (none, id, t1, t2) of all its documents."""
    nodes = staged(prints.groupBy("fingerprint").agg(F.min("named").alias("first")), "nodes")
    linked = components(fingerprint_links(nodes.select("fingerprint"), paired_bucket))
    firsts = nodes.join(linked, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "first", F.coalesce("component", "fingerprint").alias("component")
    )
    names = firsts.groupBy("component").agg(F.min("first").alias("name")).withColumnRenamed("component", "_component")
    labels = firsts.join(names, F.col("component") == F.col("_component")).select("fingerprint", "name")
    return staged(labels, "classes")


def _named(docs: DataFrame, id_column: str, text_column: str) -> Column:
    """What a document is known by: its id, null last, then two hashes of its text."""
    row_id, text = F.col(quoted(id_column)), F.col(quoted(text_column))
    return F.struct(
        row_id.isNull().alias("none"),
        row_id.alias("id"),
        F.xxhash64(text).alias("t1"),
        F.xxhash64(F.lit(1), text).alias("t2"),
    )


def near_duplicates(
    docs: DataFrame,
    keep: tuple[str, ...] | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    paired_bucket: int = PAIRED_BUCKET,
) -> DataFrame:
    """Every document with its class: row (the columns of ``keep``, or all), fingerprint, component_id.

    Documents whose fingerprints differ in at most two bits are linked;
    component_id is the smallest id reachable.  Equal fingerprints are one
    node, so copies are never paired.

    Null text counts as empty: fingerprint zero, linked like any other.  Null
    ids come last: they name a component only where it has no other id.
    Repeated rows are copies of each other.  An empty table gives no rows.
    """
    base = docs.select(
        F.struct(row_of(docs, keep or docs.columns), _named(docs, id_column, text_column).alias("named")).alias("row"),
        F.col(quoted(text_column)).alias("text"),
    )
    prints = fingerprints(base, ("row",), "text").select("row.row.row", "row.row.named", "fingerprint")
    prints = staged(prints, "fingerprints")
    labels = _classes(prints, paired_bucket).withColumnRenamed("fingerprint", "_fingerprint")
    return prints.join(labels, F.col("fingerprint") == F.col("_fingerprint")).select(
        "row", "fingerprint", F.col("name.id").alias("component_id")
    )


def one_of_each(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", paired_bucket: int = PAIRED_BUCKET
) -> DataFrame:
    """One document of each component of near duplicates, that of the smallest id, with the columns of ``docs``.

    Texts stay where they are until the ids and text hashes of the documents to
    keep are known; these are unique, so large groups of copies don't meet in one task.
    """
    named = _named(docs, id_column, text_column)
    narrow = docs.select(named.alias("named"), F.col(quoted(text_column)).alias("text"))
    prints = staged(fingerprints(narrow, ("named",), "text").select("row.named", "fingerprint"), "fingerprints")
    names = _classes(prints, paired_bucket).select("name").distinct()

    def keys(name: str) -> list[Column]:
        fields = [F.col(f"{name}.{f}") for f in ("id", "t1", "t2")]
        return [F.xxhash64(*fields).alias("_k1"), F.xxhash64(F.lit(1), *fields).alias("_k2")]

    rows = docs.select(F.struct("*").alias("row"), named.alias("named")).select("row", *keys("named"))
    kept = rows.join(names.select(*keys("name")), ["_k1", "_k2"], "left_semi").dropDuplicates(["_k1", "_k2"])
    return kept.select("row.*")
