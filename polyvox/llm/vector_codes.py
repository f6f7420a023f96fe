"""Vector code compression: product codes found by an integer Walsh-Hadamard transform.

A vector's components become integers (``floor(256 x)``), the vector is cut into 16 equal
consecutive parts and every part is replaced by the number of its nearest codebook entry.
Parts and entries are filled up with zeros to a power of two p and transformed by an integer
Walsh-Hadamard butterfly; the transform keeps squared distances up to the factor p, so squared
differences of coefficients, added in sequency order, are lower bounds that grow to p times the
exact distance. An entry leaves as soon as its sum exceeds the full distance of the entry that
was best on the first coefficient. Only integers are compared: no rounding anywhere.

Spark's share: every pass is one scan in which a task keeps 16 x 64 partial sums, and the sums
meet in a groupBy on (part, entry). Codebooks (64 x dimensions numbers, whatever the number of
rows) are all that reaches the driver and the tasks. Passes re-read the input and nothing
but the codes is written, so a lost executor costs the scan of its splits.

Defined results. Rows whose vector is null or holds null or non-finite components are dropped.
Vectors shorter than the longest, and lengths that 16 doesn't divide, are filled up with zeros
(an empty vector is all zeros). Repeated rows each count and each return a row. Codebooks
start from rows in order of (vec_id, vector), null ids last; with fewer than 64 rows they have
fewer entries. Ties go to the lower index; entries without parts stay. An empty table gives
no rows. Columns besides the three named don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polyvox.llm.common import staged
from polyvox.llm.vectors import digest, finite, floors, summed
from polyvox.operators.skew import salted_join

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256


def padded(m: int) -> int:
    """The smallest power of two not under ``m`` (1 at least)."""
    return 1 << max(0, m - 1).bit_length()


def sequency_order(p: int) -> np.ndarray:
    """Positions of the butterfly's outputs by rising number of sign changes: bit-reversed Gray codes."""
    bits = p.bit_length() - 1
    s = np.arange(p)
    gray, out = s ^ (s >> 1), np.zeros(p, np.int64)
    for _ in range(bits):
        out, gray = (out << 1) | (gray & 1), gray >> 1
    return out


def transformed(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard coefficients of the last axis, zero-padded to a power of two, in sequency order."""
    m, p = x.shape[-1], padded(x.shape[-1])
    y = np.concatenate([x, np.zeros((*x.shape[:-1], p - m), x.dtype)], axis=-1)
    h = 1
    while h < p:
        z = y.reshape(*x.shape[:-1], p // (2 * h), 2, h)
        y = np.stack([z[..., 0, :] + z[..., 1, :], z[..., 0, :] - z[..., 1, :]], axis=-2).reshape(y.shape)
        h *= 2
    return y[..., sequency_order(p)]


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row of ``x`` the nearest row of ``entries`` (ties: lowest) and the squared distance,
    both given as coefficients. Entries are dropped as soon as their partial sum is too large."""
    n, p = x.shape
    part = (x[:, :1] - entries[:, 0]) ** 2
    best = ((x - entries[part.argmin(1)]) ** 2).sum(1)  # an upper bound: the whole sum of one entry
    row, entry = np.nonzero(part <= best[:, None])
    part = part[row, entry]
    for k in range(1, p):
        part = part + (x[row, k] - entries[entry, k]) ** 2
        stays = part <= best[row]
        row, entry, part = row[stays], entry[stays], part[stays]
    start = np.searchsorted(row, np.arange(n))  # pairs stay sorted by row, then entry; each row keeps one at least
    least = np.minimum.reduceat(part, start) if n else part
    hit = np.flatnonzero(part == least[row])
    first = hit[np.searchsorted(row[hit], np.arange(n))]
    return entry[first], least // p


def _limit(m: int) -> int:
    """Components under this keep p^3 (2 c)^2, and so every sum of squares, inside 64 bits."""
    return int(2 ** 28 / padded(m) ** 1.5)


def _parts(vectors: pa.Array, m: int) -> np.ndarray:
    """n x 16 x m integers."""
    return floors(vectors, PARTS * m, SCALE, _limit(m)).reshape(len(vectors), PARTS, m)


def fit(rows: DataFrame) -> tuple[np.ndarray, int]:
    """Codebooks (16 x entries x m integers) of ``rows(id, vec)``, and m, the length of a part."""
    spark = rows.sparkSession
    longest = rows.agg(F.max(F.size("vec"))).first()[0] or 0
    m = -(-longest // PARTS)
    seeds = rows.orderBy(F.col("id").asc_nulls_last(), "vec").limit(ENTRIES).select("vec").collect()
    books = _parts(pa.array([r["vec"] for r in seeds], pa.list_(pa.float64())), m).transpose(1, 0, 2).copy()
    for _ in range(ROUNDS if m and len(seeds) else 0):
        shared = spark.sparkContext.broadcast(books)

        def run(batches: Iterator[pa.RecordBatch], m: int = m, shared=shared) -> Iterator[pa.RecordBatch]:
            now = shared.value
            coefficients, total, count = transformed(now), np.zeros_like(now), np.zeros(now.shape[:2], np.int64)
            for b in batches:
                x = _parts(b.column(0), m)
                y = transformed(x)
                for j in range(PARTS):
                    entry, _ = nearest(y[:, j], coefficients[j])
                    np.add.at(total[j], entry, x[:, j])
                    count[j] += np.bincount(entry, minlength=len(count[j]))
            part, entry = np.nonzero(count)
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(count[part, entry]),
                 pa.array(list(total[part, entry]), pa.list_(pa.int64()))], ["part", "entry", "n", "s"])

        sums = summed(rows.select("vec").mapInArrow(run, "part int, entry int, n long, s array<long>"), ["part", "entry"], m)
        shared.unpersist()
        books = books.copy()
        for r in sums:
            books[r["part"], r["entry"]] = [r[f"s{i}"] // r["n"] for i in range(m)]
    return books, m


def compress(vectors: DataFrame, id: str = "vec_id", vec: str = "embedding", label: str = "label") -> tuple[DataFrame, np.ndarray]:
    """Codes of all usable vectors, and the codebooks behind them.

    Returns ``(vec_id, label, codes array<int>, error long)``, columns named as given, written to the
    shared folder, and the codebooks as a 16 x entries x m integer array."""
    rows = vectors.select(F.col(id).alias("id"), F.col(label).alias("label"), F.col(vec).alias("vec")).filter(finite("vec"))
    books, m = fit(rows)
    shared = rows.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coefficients = transformed(shared.value) if m else None
        for b in batches:
            n = b.num_rows
            codes, error = np.zeros((n, PARTS), np.int32), np.zeros(n, np.int64)
            if m:
                y = transformed(_parts(b.column(2), m))
                for j in range(PARTS):
                    codes[:, j], d = nearest(y[:, j], coefficients[j])
                    error += d
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.FixedSizeListArray.from_arrays(pa.array(codes.ravel()), PARTS).cast(pa.list_(pa.int32())),
                 pa.array(error)], ["id", "label", "codes", "error"])

    kinds = dict(rows.dtypes)
    got = rows.mapInArrow(run, f"id {kinds['id']}, label {kinds['label']}, codes array<int>, error long")
    return staged(got, "codes").toDF(id, label, "codes", "error"), books


def decode(codes: list[int], books: np.ndarray) -> np.ndarray:
    """The integer vector (floors of 256 x, filled up to 16 m components) that codes stand for."""
    return np.concatenate([books[j, c] for j, c in enumerate(codes)])


def with_label_error(codes: DataFrame, label: str = "label") -> DataFrame:
    """Adds ``label_error``, the error summed over equal labels (nulls are equal). A label with
    a third of all rows is pre-aggregated for the sum and salted for the join back."""
    keyed = codes.withColumns({"__null": F.col(label).isNull(), "__label": F.coalesce(F.col(label).cast("string"), F.lit(""))})
    total = keyed.groupBy("__null", "__label").agg(F.sum("error").alias("label_error"))
    return salted_join(keyed, total, ["__null", "__label"], ["error", "codes"]).drop("__null", "__label")


def code_text(codes: str = "codes") -> F.Column:
    """Two lowercase hex digits per part."""
    return F.array_join(F.transform(codes, lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "")


def compressed(vectors: DataFrame) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of every usable vector."""
    codes, books = compress(vectors)
    return with_label_error(codes).select("vec_id", code_text().alias("code"), "error", "label_error",
                                          F.lit(digest(books)).alias("codebooks_sha256"))
