"""Near-duplicates by SimHash, found through a segment-popcount embedding.

A text's fingerprint has 64 bits; two texts are linked if their fingerprints
differ in at most two bits, and the connected components of the links are the
groups.  The search does not compare fingerprints with each other:

1. Equal fingerprints become one class first (counted before the shuffle), so
   copies, however many, cost one row.
2. A fingerprint is embedded as the bit counts of its 16 four-bit segments.
   Flipping a bit moves one count by one, so the Manhattan distance of two
   embeddings is a lower bound of the Hamming distance.
3. Grid range join: two embeddings at a Manhattan distance of two or less have
   a common grid point at a distance of one or less from both.  Every class is
   put on its own grid point and on the (at most 32) points next to it;
   classes that meet on a point are compared bit by bit.
4. A crowded grid point is not compared pair by pair.  Its classes go through
   the same join on the finest grid, whose segments are single bits: there the
   points within distance one of a fingerprint are its 64 one-bit neighbours
   and itself, the bound is the distance itself, no point has more than 65
   classes, and linking each to the smallest one connects them all.  Nothing is
   dropped: two classes that only meet on crowded points are both refined.

Defined results: a null or wordless text has fingerprint zero and is linked
like any other; null ids are kept, and a component's id is its smallest
non-null id (null if there is none); repeated rows stay rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SALTS, WORD_BYTES, cut, fresh, map_arrow, raw, salt, spread_join
from .components import connected_components

SEGMENTS = 16
SEGMENT_BITS = 4
CROWDED = 64      # classes on a grid point beyond which the finest grid takes over
MAX_DISTANCE = 2  # what the meeting-point argument above covers


def fingerprint(text: bytes | None, shingle: int = 3, seed: int = 42) -> int:
    """The bits set in over half of the word shingles' XXH64 values, repeats included."""
    words = WORD_BYTES.findall(text.lower()) if text else []
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    stops = ends[shingle - 1:].tolist()
    starts = [0, *(ends[:len(stops) - 1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, len(stops), 1 << 16):  # bounded scratch space for very long texts
        hashes = np.array([digest(joined[a:b], seed) for a, b in
                           zip(starts[at:at + (1 << 16)], stops[at:at + (1 << 16)])], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(0, dtype=np.int64)
    majority = np.packbits(2 * counts > len(stops), bitorder="little")
    return int.from_bytes(majority.tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = 3) -> DataFrame:
    """``(id, fp)``: fp is the fingerprint as a signed long."""
    def run(batches):
        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for t in raw(batch.column(1))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["id", "fp"])

    slim = docs.select(F.col(f"`{id_col}`").alias("id"),
                       F.col(f"`{text_col}`").cast("string").cast("binary").alias("text"))
    return map_arrow(slim, run, f"id {dict(slim.dtypes)['id']}, fp long")


def embedding(fp: Column) -> Column:
    """The 16 segment bit counts, four bits each in one long (counts stay below 5)."""
    def masked(c: Column, mask: int) -> Column:
        return c.bitwiseAND(F.lit(mask))

    def halves(c: Column, shift: int, mask: int) -> Column:
        # Pairwise sums; the top lane is added apart, as it could leave the long's range.
        low = mask & ((1 << 60) - 1)
        even, odd = masked(c, low), masked(F.shiftrightunsigned(c, shift), low)
        return even + odd

    def counts(c: Column) -> Column:  # c: the low 60 bits, 15 segments
        pairs = halves(c, 1, 0x5555555555555555)
        return halves(pairs, 2, 0x3333333333333333)

    top = F.bit_count(masked(F.shiftrightunsigned(fp, 60), 15)).cast("long")
    return counts(masked(fp, (1 << 60) - 1)) + F.shiftleft(top, 60)


def grid_points(cell: Column) -> Column:
    """The embedding itself and those that differ by one in one count."""
    points = [cell]
    for i in range(SEGMENTS):
        count = F.shiftrightunsigned(cell, SEGMENT_BITS * i).bitwiseAND(F.lit(15))
        step = F.lit(1 << (SEGMENT_BITS * i)).cast("long")
        points.append(F.when(count < SEGMENT_BITS, cell + step))
        points.append(F.when(count > 0, cell - step))
    return F.array(*points)


def one_bit_neighbours(fp: Column) -> Column:
    signed = [(1 << i) - (1 << 64 if i == 63 else 0) for i in range(64)]
    return F.array(fp, *[fp.bitwiseXOR(F.lit(x).cast("long")) for x in signed])


def links(classes: DataFrame, distance: int = MAX_DISTANCE) -> DataFrame:
    """Edges ``(a, b)`` that connect the distinct fingerprints ``fp`` within ``distance`` bits.

    Crowded spots give a spanning set of edges rather than all pairs.
    """
    if not 0 <= distance <= MAX_DISTANCE:
        raise ValueError(f"distance must be 0 to {MAX_DISTANCE}")
    # Each row becomes some thirty: deal them out first, whatever few partitions they come in.
    spread = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = classes.select("fp").repartition(spread).select("fp", embedding(F.col("fp")).alias("cell"))
    placed = cells.select("fp", F.explode(grid_points(F.col("cell"))).alias("point")).where("point is not null")
    # Most points hold one class: count once, and only what meets goes on.
    crowd = cut(placed.groupBy("point").agg(F.count("*").alias("n"), F.min("fp").alias("lo"),
                                            F.max("fp").alias("hi")).where("n > 1"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    pairs = crowd.where("n = 2").select(F.col("lo").alias("a"), F.col("hi").alias("b")).where(near)
    several = placed.join(crowd.where("n > 2").select("point", "n"), "point")
    several = cut(several.select("point", "n", "fp"))
    small = several.where(F.col("n") <= CROWDED)
    more = (small.select("point", F.col("fp").alias("a"))
            .join(small.select("point", F.col("fp").alias("b")), "point")
            .where((F.col("a") < F.col("b")) & near).select("a", "b"))
    fine = (several.where(F.col("n") > CROWDED).select("fp").distinct()
            .select("fp", F.explode(one_bit_neighbours(F.col("fp"))).alias("point")))
    if distance < 2:
        # One bit apart: one of the two sits on a neighbour of the other.
        fine_links = (fine.where("point <> fp").join(fine.where("point = fp").select("point"), "point")
                      .select(F.col("fp").alias("a"), F.col("point").alias("b")))
        fine_links = fine_links.where("a < b" if distance else "false")
    else:
        low = fine.groupBy("point").agg(F.count("*").alias("n"), F.min("fp").alias("lo")).where("n > 1")
        fine_links = fine.join(low, "point").where("fp <> lo").select(F.col("fp").alias("a"), F.col("lo").alias("b"))
    return pairs.union(more).union(fine_links).distinct()


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
           distance: int = MAX_DISTANCE) -> DataFrame:
    """One row per document: id, ``fingerprint`` (16 hex digits) and ``component_id``.

    ``component_id`` is the smallest id that links lead to, the own included.
    """
    # A text (the empty one, say) and a group may hold a third of all rows: both joins are salted.
    row = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")
    prints = cut(fingerprints(docs, id_col, text_col, shingle).withColumn("row", row))
    classes = prints.groupBy("fp").agg(F.min("id").alias("first"))
    component = connected_components(links(classes.select("fp"), distance))
    joined = classes.join(component, classes["fp"] == component["node"], "left")
    rooted = joined.select("fp", "first", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = spread_join(rooted, smallest, "root", salt(F.col("fp"))).select("fp", "component_id")
    return spread_join(prints, named, "fp", F.col("row")).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", shingle: int = 3,
               distance: int = MAX_DISTANCE) -> DataFrame:
    """One document of each group stays: the one with the smallest id.

    Rows that share even the id are told apart by a row mark, so that exactly
    one row of a group stays; null ids come last.
    """
    mark, fp = fresh(docs, "row"), fresh(docs, "fp")

    @F.arrow_udf("long")
    def prints(texts: pa.Array) -> pa.Array:
        values = np.array([fingerprint(t, shingle) for t in raw(texts)], dtype=np.uint64)
        return pa.array(values.view(np.int64))

    text = F.col(f"`{text_col}`").cast("string").cast("binary")
    marked = cut(docs.withColumn(fp, prints.asNondeterministic()(text))
                 .withColumn(mark, F.monotonically_increasing_id()))
    slim = marked.select(F.col(fp).alias("fp"), F.col(f"`{id_col}`").alias("id"), F.col(mark).alias("row"))
    order = F.struct(F.col("id").isNull().alias("none"), "id", "row")
    classes = slim.groupBy("fp").agg(F.min(order).alias("first"))
    component = connected_components(links(classes.select("fp"), distance))
    joined = classes.join(component, classes["fp"] == component["node"], "left")
    chosen = joined.groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("first").alias("first"))
    rows = chosen.select(F.col("first.row").alias(mark))
    return marked.join(rows, mark, "left_semi").select([F.col(f"`{c}`") for c in docs.columns])
