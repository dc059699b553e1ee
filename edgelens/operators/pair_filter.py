"""A Bloom filter of supervoxel pairs, to cut an edge table at its scan.

A list asks for few of the edges there are. Joining the two on the pair would shuffle every edge;
the filter, a table of bounded size that every task gets, drops nearly all that are not asked for
before any shuffle. What passes is a superset: an exact join has to follow.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A bucket is a row of so many 64-bit words. A pair sets so many bits of one bucket.
WORDS, PROBES = 64, 3
BUCKET_BITS = WORDS * 64
# At this many bits a pair, one edge in 150 passes unasked; more pairs than fit the largest filter
# (64 MB, 33 million pairs) make it pass more.
BITS_PER_PAIR = 16
MOST_BUCKETS = (1 << 29) // BUCKET_BITS

_HASH = "xxhash64(sv_a, sv_b)"
# The bucket is told by the lowest bits of the hash, the bits within it by its highest.
_PROBE_BITS = [
    f"cast(shiftrightunsigned({_HASH}, {64 - 12 * (i + 1)}) & {BUCKET_BITS - 1} AS int)" for i in range(PROBES)
]


def buckets_for(n_pairs: int) -> int:
    """Buckets, a power of two, of a filter of so many ordered pairs."""
    wanted = max(1, -(-n_pairs * BITS_PER_PAIR // BUCKET_BITS))
    return min(MOST_BUCKETS, 1 << (wanted - 1).bit_length())


def _bucket(buckets: int) -> str:
    return f"cast({_HASH} & {buckets - 1}L AS int)"


def pair_filter(pairs: DataFrame, buckets: int) -> DataFrame:
    """The filter of the ordered pairs (sv_a, sv_b): at most ``buckets`` rows of (_bucket, _words)."""
    bits = pairs.selectExpr(f"{_bucket(buckets)} AS _bucket", f"explode(array({', '.join(_PROBE_BITS)})) AS _bit")
    words = bits.groupBy("_bucket", F.expr("_bit div 64").cast("int").alias("_word")).agg(
        F.bit_or(F.expr("shiftleft(1L, _bit % 64)")).alias("_mask")
    )
    # 64 words a bucket
    gathered = words.groupBy("_bucket").agg(F.map_from_entries(F.collect_list(F.struct("_word", "_mask"))).alias("_set"))
    return gathered.selectExpr(
        "_bucket", f"transform(sequence(0, {WORDS - 1}), w -> coalesce(try_element_at(_set, w), 0L)) AS _words"
    )


def may_be_wanted(edges: DataFrame, pairs: DataFrame, n_pairs: int) -> DataFrame:
    """The ``edges`` whose ordered pair (sv_a, sv_b) may be among ``pairs``; every one that is.

    ``n_pairs`` only sizes the filter: a wrong number lets more edges pass. Pairs with a null are
    never wanted.
    """
    buckets = buckets_for(n_pairs)
    known = pair_filter(pairs.where("sv_a IS NOT NULL AND sv_b IS NOT NULL"), buckets)
    probes = " AND ".join(f"getbit(get(_words, {bit} div 64), {bit} % 64) = 1" for bit in _PROBE_BITS)
    # of bounded size: MOST_BUCKETS rows of half a kilobyte at most
    return edges.join(F.broadcast(known), F.expr(_bucket(buckets)) == F.col("_bucket")).where(probes).drop("_bucket", "_words")
