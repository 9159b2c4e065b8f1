"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Texts have 64-bit fingerprints of their word shingles; two link at three or fewer
differing bits. Every distinct fingerprint emits the variants within half that radius,
and linked fingerprints meet on one of them:

* at two differing bits or fewer, both reach a variant by flipping one bit at most;
* at three, one of the two has an odd number of set bits. Two of the three bits lie in
  the same half of the word, so the odd one flips two bits of one half and the other
  fingerprint the third bit. Flips of two bits that lie in different halves, or of a
  fingerprint with an even count, would only find the same pairs again and are left out.

Variants are shuffled as packed numbers of eight bytes: a variant is mixed by a one-to-one
function, its leading bits name a bucket, and the rest leaves room for the flips that
undo it. Where fingerprints collide, those at most one flip away are linked pairwise and
to all two flips away; two that both flipped two bits prove nothing. So the first member,
if it flipped one bit or none, is linked to every other: the same components, with one
verified link per member instead of all pairs.

Defined results: a null text counts as an empty one, whose fingerprint is zero; null and
repeated ids keep a row each, and a component's id is the smallest that is not null; an
empty table gives an empty result; columns other than the id and the text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendtide.llm.components import components
from spendtide.llm.texts import keep_one, map_texts, with_key
from spendtide.plans.materialize import materialize

WORDS, RADIUS, SEED = 3, 3, 42
#: Variants that one bucket holds in the mean, eight bytes each.
BUCKET_VARIANTS = 4_000_000
#: Fingerprints of a task that emits variants, and of those that it holds variants of.
_TASK, _SLICE = 16_384, 4096
_ODD = 0x9E3779B97F4A7C15
_MIX, _UNMIX = np.uint64(_ODD), np.uint64(pow(_ODD, -1, 1 << 64))

_ones = [0] + [1 << i for i in range(64)]
_twos = [(1 << i | 1 << j) << half for half in (0, 32) for i, j in combinations(range(32), 2)]
#: Flips by code: none, one bit, two bits of one half.
FLIPS = np.array(_ones + _twos, dtype=np.uint64)
_NEAR = np.uint64(len(_ones))


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """Majority bits of the shingles' XXH64, A-Z lower-cased; zero without a word."""
    parts = text.lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = list(accumulate(map(len, parts), lambda end, size: end + 1 + size))
    starts = [0] + [end + 1 for end in ends[:-1]]
    ends = ends[words - 1 :] or ends[-1:]
    one = xxhash.xxh64_intdigest
    hashes = np.fromiter((one(joined[s:e], SEED) for s, e in zip(starts, ends)), np.uint64, len(ends))
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    majority = bits.sum(axis=0, dtype=np.int64) * 2 > len(hashes)
    return int(np.packbits(majority, bitorder="little").view(np.uint64)[0])


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
    **more: str,
) -> DataFrame:
    """(id, fp) of every row and the columns that ``more`` names (new name to old);
    ``fp`` holds the 64 bits as a signed long."""

    def work(texts: list[bytes]) -> dict[str, pa.Array]:
        found = np.fromiter((fingerprint(t, words) for t in texts), np.uint64, len(texts))
        return {"fp": pa.array(found.view(np.int64))}

    keep = {id_col: "id"} | {old: new for new, old in more.items()}
    return map_texts(docs, text_col, keep, work, "fp long")


def _mixed(variants: np.ndarray) -> np.ndarray:
    mixed = variants * _MIX
    return mixed ^ (mixed >> np.uint64(32))


def _unmixed(mixed: np.ndarray) -> np.ndarray:
    return (mixed ^ (mixed >> np.uint64(32))) * _UNMIX


def _variants(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mixed variants of every fingerprint, and the codes of the flips."""
    odd = np.bitwise_count(fps) % 2 == 1
    near, far = FLIPS[: int(_NEAR)], FLIPS[int(_NEAR) :]
    found = [(fps[:, None] ^ near).ravel(), (fps[odd][:, None] ^ far).ravel()]
    codes = [
        np.tile(np.arange(len(near), dtype=np.uint64), len(fps)),
        np.tile(np.arange(len(near), len(FLIPS), dtype=np.uint64), int(odd.sum())),
    ]
    return _mixed(np.concatenate(found)), np.concatenate(codes)


def emit(fps: DataFrame, bits: int) -> DataFrame:
    """(bucket, packed): the variants of ``fps``, packed by the bucket of ``bits`` bits."""
    top, rest = np.uint64(64 - bits), np.uint64((1 << (64 - bits)) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            for start in range(0, len(values), _SLICE):
                mixed, codes = _variants(values[start : start + _SLICE])
                bucket = (mixed >> top).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                packed = (((mixed & rest) << np.uint64(12)) | codes)[order]
                bucket = bucket[order]
                at = np.flatnonzero(np.diff(bucket, prepend=-1))
                ends = np.append(at[1:], len(bucket)) * 8
                data = packed.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket[at]),
                     pa.array([data[s:e] for s, e in zip(at * 8, ends)], pa.binary())],
                    ["bucket", "packed"],
                )

    return fps.mapInArrow(run, "bucket long, packed binary")


def collisions(bucket: int, packed: np.ndarray, bits: int, radius: int = RADIUS) -> np.ndarray:
    """Links (two columns) of one bucket: first member and each other one of a variant."""
    packed = np.sort(packed)
    variant, code = packed >> np.uint64(12), packed & np.uint64(4095)
    first = np.flatnonzero(np.diff(variant, prepend=~variant[:1]))
    size = np.diff(np.append(first, len(variant)))
    wanted = np.repeat((size > 1) & (code[first] < _NEAR), size)
    mixed = np.uint64(bucket << (64 - bits)) | variant
    fps = _unmixed(mixed[wanted]) ^ FLIPS[code[wanted].astype(np.int64)]
    lead = np.repeat(first, size)[wanted]
    lead = _unmixed(mixed[lead]) ^ FLIPS[code[lead].astype(np.int64)]
    distance = np.bitwise_count(fps ^ lead)
    pairs = np.stack([lead, fps], axis=1)[(distance > 0) & (distance <= radius)]
    return np.unique(pairs, axis=0)


def links(fps: DataFrame) -> DataFrame:
    """Verified links (a, b) between the distinct, stored fingerprints ``fps`` (fp)."""
    count = fps.count()
    mean = (len(_ones) + len(_twos) / 2) * count
    fps = fps.repartition(max(1, -(-count // _TASK)), "fp")  # a slice emits far more than it is
    bits = max(12, int(np.ceil(np.log2(max(1, mean / BUCKET_VARIANTS)))))

    def meet(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        data = b"".join(table.column("packed").to_pylist())
        found = collisions(key[0].as_py(), np.frombuffer(data, np.uint64), bits)
        found = found.astype(np.uint64).view(np.int64).reshape(-1, 2)
        return pa.table({"a": pa.array(found[:, 0]), "b": pa.array(found[:, 1])})

    return emit(fps, bits).groupBy("bucket").applyInArrow(meet, "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS
) -> DataFrame:
    """One row per row of ``docs``: id, fingerprint (16 hexadecimal digits) and
    component_id, the smallest id in reach by links."""
    return _with_components(fingerprints(docs, id_col, text_col, words)).select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def _with_components(marked: DataFrame) -> DataFrame:
    """``marked`` (id, fp and others) with root, which names the component, and
    component_id."""
    rows = materialize(marked, "fingerprints")
    fps = materialize(rows.groupBy("fp").agg(F.min("id").alias("id")), "distinct-fingerprints")
    roots = components(links(fps.select("fp")))
    known = fps.join(roots, fps.fp == roots.node, "left").select(
        "fp", "id", F.coalesce("root", "fp").alias("root")
    )
    known = materialize(known, "roots")
    least = materialize(known.groupBy("root").agg(F.min("id").alias("component_id")), "least-ids")
    by_fp = known.join(least, "root").select("fp", "root", "component_id")
    by_fp = materialize(by_fp, "components")
    return rows.join(by_fp, "fp")


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS
) -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they were: of each component the
    row with the smallest id, and one row where several have it or none has one."""
    keyed = with_key(docs, id_col, text_col)
    found = _with_components(fingerprints(keyed, "id", text_col, words, check="check"))
    least = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "check"))
    stays = found.groupBy("root").agg(least.alias("key")).select("key.id", "key.check")
    return keep_one(docs, materialize(stays, "first-of-component"), id_col, text_col)
