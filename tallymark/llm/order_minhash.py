"""Document fingerprints by Order MinHash, in built-in functions only.

A text's k-mers are its runs of ``K`` words, numbered by occurrence, so that the second "of the" is
another k-mer than the first. Each component of a signature has an order of the numbered k-mers:
it takes the two that come first in it, puts them back into text order and hashes the two k-mers as a tuple. Two
texts agree in a component when they share these k-mers and their sequence, so moving a
passage lowers the likeness as well as replacing it: the share of equal components follows the edit distance.

There are ``SEEDS`` hash orders, each begun at ``STARTS`` evenly spaced values and read around the
circle, which gives SEEDS * STARTS components from SEEDS sorts.

``fingerprint_edits`` compares each text with an edited version of itself and with the next text.
Texts are dealt once, into chunks of the order of ids; the first text of each chunk goes also to the
chunk before, so that no text has to be looked up again.

Defined cases: a null text is an empty one; the k-mers at the end of a text are its last words; texts without words
have one and the same fingerprint. Null ids come last; rows with equal or null ids are ordered by a hash of the
text; repeated rows are rows of their own; the only row of a table is its own next; an empty table gives an
empty table; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Words of a k-mer; hash orders; places at which each order is begun.
K, SEEDS, STARTS = 2, 2, 32
#: Rows of a chunk, and chunks at most (bounds of chunks pass through the driver, 8 bytes each).
CHUNK_ROWS, MOST_CHUNKS = 2048, 65_536

BLANKS = r"[\x20\x09-\x0D]+"
#: Packed numbers: 32 bits of a hash above 31 bits of a place in an array, which has fewer than 2^31 entries.
PLACE_BITS, HASH_MASK, PLACE_MASK = 31, (1 << 32) - 1, (1 << 31) - 1
#: Numbers of occurrence that are tried one by one.
FEW = 4


def _starts() -> list[int]:
    """The packed values at which an order is begun, evenly spaced and ascending."""
    return [(2 * i + 1) * (1 << 63) // (2 * STARTS) for i in range(STARTS)]


def _steps(bits: int = 31) -> Column:
    """Falling powers of two below 2^bits."""
    return F.array(*[F.lit(1 << b) for b in range(bits - 1, -1, -1)])


def _longest(holds: Callable[[Column], Column], steps: Column) -> Column:
    """The largest t, a sum of the steps, up to which ``holds`` is true."""
    return F.aggregate(steps, F.lit(0), lambda t, d: F.when(holds(t.bitwiseOR(d)), t.bitwiseOR(d)).otherwise(t))


def _hash(packed: Column) -> Column:
    return F.shiftright(packed, PLACE_BITS)


def _pack(hashed: Column, place: Column) -> Column:
    return F.shiftleft(hashed.bitwiseAND(HASH_MASK), PLACE_BITS).bitwiseOR(place.cast("long"))


def _components(order: str) -> Column:
    """For each start the hash of the first two k-mers of an order, in text order."""
    n, starts = F.size("_packed"), F.array(*[F.lit(c) for c in _starts()])

    def kmer(i: Column) -> Column:
        """The packed k-mer that is i-th in the order, counted around the circle."""
        return F.get("_packed", F.get(order, F.pmod(i, n)).bitwiseAND(PLACE_MASK).cast("int"))

    before = F.transform(starts, lambda c: _longest(lambda t: F.get(order, t - 1) < c, F.col("_steps")))
    pairs = F.transform(before, lambda b: F.array(kmer(b), kmer(b + 1)))
    in_text = F.transform(pairs, lambda p: F.when(
        p[0].bitwiseAND(PLACE_MASK) > p[1].bitwiseAND(PLACE_MASK), F.array(p[1], p[0])).otherwise(p))
    return F.transform(in_text, lambda p: F.xxhash64(_hash(p[0]), _hash(p[1])).bitwiseAND(HASH_MASK))


def add_signature(texts: DataFrame, text: str, out: str) -> DataFrame:
    """The rows with ``out``: the components of a text's signature, an array of 32-bit numbers.

    Columns that start with ``_`` are used on the way; select what is wanted under other names before.
    """
    kept = [c for c in texts.columns if c != out]
    words = texts.withColumn("_words", F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), BLANKS), ""))

    def kmer(word: Column, i: Column) -> Column:
        return _pack(F.xxhash64(word, *[F.get("_words", i + j) for j in range(1, K)]), i)

    kmers = words.select(*kept, F.sort_array(F.transform("_words", kmer)).alias("_packed"))

    def numbered(value: Column, i: Column) -> Column:
        """The k-mer with its number of occurrence: equal ones stand together, in text order."""
        def same(back: Column) -> Column:
            # null where the array has no such place
            return F.get("_packed", i - back).bitwiseXOR(value) <= PLACE_MASK

        number = _longest(same, _steps())
        for t in range(FEW - 1, -1, -1):
            number = F.when(same(F.lit(t + 1)), number).otherwise(t)
        return F.xxhash64(_hash(value), number)

    kmers = kmers.select("*", F.transform("_packed", numbered).alias("_numbered"))
    def ordered(seed: int) -> Column:
        return F.sort_array(F.transform("_numbered", lambda v, i: _pack(F.xxhash64(v, F.lit(seed)), i)))

    orders = [f"_order{s}" for s in range(SEEDS)]
    steps = F.filter(_steps(), lambda s: s <= F.size("_packed"))
    kmers = kmers.select(*kept, "_packed", steps.alias("_steps"), *[ordered(s).alias(o) for s, o in enumerate(orders)])
    none = F.array_repeat(F.lit(0).cast("long"), SEEDS * STARTS)
    parts = F.concat(*[_components(o) for o in orders])
    return kmers.select(*kept, F.when(F.size("_packed") > 0, parts).otherwise(none).alias(out))


def as_text(signature: str) -> Column:
    """The components in hexadecimal digits."""
    return F.lower(F.array_join(F.transform(signature, F.hex), "-"))


def likeness(a: str, b: str) -> Column:
    """Share of equal components, 0 to 1."""
    equal = F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda e: e)
    return F.size(equal) / F.lit(float(SEEDS * STARTS))


def signatures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fingerprint`` of every text; no shuffle."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return add_signature(rows, "text", "signature").select("doc_id", as_text("signature").alias("fingerprint"))


def _chunked(rows: DataFrame) -> DataFrame:
    """The rows with ``chunk``: chunks follow each other as descending ids do, null ids after all others.

    There is a bound for every CHUNK_ROWS rows, at most MOST_CHUNKS (larger tables get larger chunks, which are
    sorted on disk). Rows with null ids are dealt to as many chunks, by the hash they are ordered by.
    """
    wanted = min(MOST_CHUNKS, -(-rows.count() // CHUNK_ROWS)) or 1
    bounds = []
    if wanted > 1:
        # percentages have to be a constant, which a function over an array is not; one text, as a call for each takes long
        shares = F.expr("array(" + ",".join(f"{i / wanted!r}D" for i in range(1, wanted)) + ")")
        bounds = rows.agg(F.percentile_approx("doc_id", shares, max(10_000, 8 * wanted)).alias("bounds")).first()[0] or []
    down = sorted(set(bounds), reverse=True)
    # one literal once folded, however long
    listed = F.split(F.lit(",".join(map(str, down))), ",").cast("array<bigint>")
    chunk = _longest(lambda t: F.get(listed, t - 1) > F.col("doc_id"), _steps(len(down).bit_length())) if down else F.lit(0)
    share = F.shiftrightunsigned(F.col("tie").bitwiseXOR(F.lit(-(1 << 63))), 1) / F.lit(float(1 << 63))
    last = F.lit(len(down) + wanted) - F.floor(share * wanted).cast("int")
    return rows.withColumn("chunk", F.when(F.col("doc_id").isNull(), last).otherwise(chunk))


def with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row with its signature and the text and signature of the row with the next smaller id.

    Columns: ``doc_id, text, signature, next_text, next_signature``. After the last row comes the first.
    """
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole.alias("text"))
    rows = _chunked(rows.withColumn("tie", F.xxhash64("text")))
    # the first row of each chunk, to be sent to the chunk before as well; at most 2 * MOST_CHUNKS keys
    firsts = rows.groupBy("chunk").agg(F.max(F.struct("doc_id", "tie")).alias("first"))
    down = Window.partitionBy(F.lit(0)).orderBy("chunk")
    around = down.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.lag("chunk").over(down), F.last("chunk").over(around))
    firsts = firsts.select(F.col("first.doc_id").alias("_id"), F.col("first.tie").alias("_tie"), before.alias("_to"))
    found = rows.join(F.broadcast(firsts), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("tie") == F.col("_tie")))
    copies = found.select("doc_id", "text", "tie", F.col("_to").alias("chunk")).dropDuplicates(["chunk"])
    dealt = rows.withColumn("copied", F.lit(False)).unionByName(copies.withColumn("copied", F.lit(True)))
    dealt = add_signature(dealt, "text", "signature")
    order = Window.partitionBy("chunk").orderBy("copied", F.desc_nulls_last("doc_id"), F.desc("tie"))
    return dealt.select(
        "doc_id", "text", "signature", "copied",
        F.lead("text").over(order).alias("next_text"), F.lead("signature").over(order).alias("next_signature"),
    ).where("not copied").drop("copied")


def fingerprint_edits(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each text's fingerprint, that of its edited version, and the likeness to this and to the next text.

    The edited version has the last half of the code points replaced by as many first ones of the next text.
    """
    rows = with_next(docs, doc_id, text).withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substring("next_text", F.lit(1), half))
    rows = rows.select("doc_id", "n_chars", "signature", "next_signature", edited.alias("edited"))
    rows = rows.withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256))
    rows = add_signature(rows, "edited", "edited_signature")
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", as_text("signature").alias("fingerprint"),
        as_text("edited_signature").alias("edited_fingerprint"),
        likeness("signature", "edited_signature").alias("near_edited"), likeness("signature", "next_signature").alias("near_next"),
    )
