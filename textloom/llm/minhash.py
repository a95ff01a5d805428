"""One-permutation MinHash fingerprints in DataFrame functions only.

Every word shingle is hashed once; its highest bits name a bin, and a bin keeps
its smallest hash. Empty bins are filled by optimal densification: bin j probes
other bins in an order given by 2-universal hashes until it meets one that is
not empty, and borrows its value. Stored are the low 8 bits of each bin;
likeness corrects for their chance agreement.

Words are what blanks part in the lower-cased text; shingles are five words, or
the whole sequence of fewer. Texts without words (null, empty, blank) have the
fingerprint '' and a likeness
of 1 to each other and 0 to all others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.llm.common import load

BIN_BITS = 7
BINS = 1 << BIN_BITS
LOW_BITS = 8
SHINGLE = 5
#: Hashed probes of an empty bin; one that finds only empty bins (texts of few words) takes the next full bin after its last probe, cyclically.
PROBES = 8
#: Documents of one window when a document looks up its successor.
RUN_ROWS = 1024
FINE_BINS = 1 << 16
#: Blanks, which part words.
BLANKS = " \t\n\x0b\f\r"


def _probes() -> list[int]:
    """Bin j, probe r -> ((a_r j + b_r) mod p) mod BINS, flat."""
    p, out = (1 << 31) - 1, []
    draws = [pow(48271, i + 1, p) for i in range(2 * PROBES)]
    for j in range(BINS):
        out += [((draws[2 * r] * j + draws[2 * r + 1]) % p) % BINS for r in range(PROBES)]
    return out


def _literal(values: list) -> Column:
    return F.array(*[F.lit(v) for v in values])


def word_hashes(text: Column) -> Column:
    """A hash for each word."""
    bare = F.btrim(F.lower(text), F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<bigint>")).otherwise(F.transform(F.split(bare, "\\s+"), lambda x: F.xxhash64(x)))


def shingle_hashes(words: Column) -> Column:
    """A hash for each run of SHINGLE words, or one for all of fewer. ``words`` must be a plain column."""
    runs = F.transform(F.slice(words, F.lit(1), F.greatest(F.size(words) - (SHINGLE - 1), F.lit(0))), lambda x, i: F.xxhash64(x, *[F.get(words, i + k) for k in range(1, SHINGLE)]))
    return F.when(F.size(words) >= SHINGLE, runs).when(F.size(words) == 0, F.array().cast("array<bigint>")).otherwise(F.array(F.xxhash64(words)))


def with_bins(df: DataFrame, hashes: Column, out: str) -> DataFrame:
    """Adds ``out``: the low bits of each bin after densification, as bytes; empty array where there are no hashes."""
    s, v, full = (f"__{out}_{x}" for x in ("sorted", "values", "full"))
    mask, shift = (1 << (64 - BIN_BITS)) - 1, 64 - BIN_BITS
    # A bin's marker sorts behind all of its hashes: what comes first in a bin is its minimum, or the marker of an empty bin.
    signed = lambda x: x - (1 << 64) if x >= 1 << 63 else x
    markers = _literal([signed((j << shift) | mask) for j in range(BINS)])
    df = df.withColumn(s, F.sort_array(F.concat(hashes, markers)))
    bin_of = lambda x: F.shiftright(x, shift)
    firsts = F.filter(F.col(s), lambda x, i: ~bin_of(x).eqNullSafe(bin_of(F.get(F.col(s), i - 1))))
    empty = lambda x: x.bitwiseAND(F.lit(mask)) == mask
    df = df.withColumn(v, F.transform(firsts, lambda x: F.when(empty(x), F.lit(-1)).otherwise(x.bitwiseAND(F.lit((1 << LOW_BITS) - 1)).cast("int"))))
    df = df.withColumn(full, F.filter(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda j: F.get(F.col(v), j) >= 0))
    probes = _literal(_probes())
    numbers = F.sequence(F.lit(0), F.lit(PROBES - 1))
    found = lambda j: F.aggregate(numbers, F.lit(-1), lambda a, r: F.when(a >= 0, a).otherwise(F.get(F.col(v), F.get(probes, j * PROBES + r))))
    last = lambda j: F.get(probes, j * PROBES + (PROBES - 1))
    after = lambda j: F.get(F.col(v), F.pmod(F.array_min(F.transform(F.col(full), lambda b: F.pmod(b - last(j), F.lit(BINS)))) + last(j), F.lit(BINS)))
    filled = F.transform(F.col(v), lambda x, j: F.when(x >= 0, x).otherwise(F.coalesce(F.nullif(found(j), F.lit(-1)), after(j))))
    filled = F.when(F.size(full) == BINS, F.col(v)).otherwise(filled)
    made = F.when(F.size(full) == 0, F.array().cast("array<tinyint>")).otherwise(F.transform(filled, lambda x: (x - 128).cast("tinyint")))
    return df.withColumn(out, made).drop(s, v, full)


def packed(bins: Column) -> Column:
    """Fingerprint as lower-case hex, two digits a bin."""
    digits = _literal([f"{i:02x}" for i in range(256)])
    return F.array_join(F.transform(bins, lambda x: F.get(digits, x.cast("int") + 128)), "")


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity: the share of equal bins, corrected for chance agreement of the stored bits."""
    chance = 1.0 / (1 << LOW_BITS)
    same = F.aggregate(F.zip_with(a, b, lambda x, y: F.when(x == y, 1).otherwise(0)), F.lit(0), lambda s, x: s + F.coalesce(x, F.lit(0)))
    value = F.greatest(F.lit(0.0), (same / F.lit(float(BINS)) - chance) / (1 - chance))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(value)


def fingerprint(df: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """Adds the packed fingerprint of every whole text. No shuffle."""
    df = df.withColumn("__words", word_hashes(F.coalesce(F.col(text), F.lit(""))))
    return with_bins(df, shingle_hashes(F.col("__words")), "__bins").withColumn(out, packed(F.col("__bins"))).drop("__bins", "__words")


def in_runs(df: DataFrame, id_col: str) -> tuple[DataFrame, Window]:
    """Rows tagged with runs of neighbouring ids, and the window in which each row's successor follows it.

    Ids are cut into runs of about RUN_ROWS rows by a histogram of at most
    FINE_BINS bins; each run also gets a ghost of the first row of the run after
    it (the last run: of the first run), marked by ``__place.ghost`` = 1. So one
    shuffle by run suffices, and no run grows with the table (but for ids that
    crowd into one bin). Nulls come first; equal ids are ordered by ``__tie``.
    """
    span = df.agg(F.min(id_col).alias("a"), F.max(id_col).alias("b")).first()
    low, high = (span["a"], span["b"]) if span["a"] is not None else (0, 0)
    step = max(1, -(-(high - low + 1) // FINE_BINS))
    fine = F.coalesce(F.expr(f"CAST((CAST(`{id_col}` AS DECIMAL(20,0)) - {low}) div {step} AS BIGINT)"), F.lit(-1).cast("long"))
    bins = df.select(F.col(id_col).alias("id"), fine.alias("__fine")).groupBy("__fine").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("least"))
    order = Window.orderBy("__fine")
    bins = bins.withColumn("__run", F.floor((F.sum("n").over(order) - F.col("n")) / RUN_ROWS))
    run, every = Window.partitionBy("__run"), Window.orderBy("__run").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    bins = bins.withColumn("__start", F.min("__fine").over(run)).withColumn("__least", F.min_by("least", "__fine").over(run))
    starts = bins.where("__fine = __start").select("__run", F.coalesce(F.lag("__run").over(Window.orderBy("__run")), F.max("__run").over(every)).alias("__before"))
    bins = bins.join(starts, "__run").select("__fine", "__run", "__before", (F.col("__fine") == F.col("__start")).alias("__opens"), "__least")
    tagged = df.withColumn("__fine", fine).join(F.broadcast(bins), "__fine")  # at most FINE_BINS + 1 rows
    first = F.col("__opens") & F.col(id_col).eqNullSafe(F.col("__least"))
    own = F.struct(F.col("__run").alias("run"), F.lit(0).alias("ghost"))
    lent = F.struct(F.col("__before").alias("run"), F.lit(1).alias("ghost"))
    tagged = tagged.select(*df.columns, F.explode(F.when(first, F.array(own, lent)).otherwise(F.array(own))).alias("__place"))
    tagged = tagged.select(*df.columns, F.col("__place.run").alias("__run"), F.col("__place.ghost").alias("__ghost"))
    return tagged, Window.partitionBy("__run").orderBy("__ghost", F.col(id_col).asc_nulls_first(), "__tie")


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    A text and its edited text share the words before the cut; these are hashed
    once, and so are their shingles.
    """
    docs = load(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs, follow = in_runs(docs.withColumn("__tie", F.xxhash64("text")), "doc_id")
    n = F.length("text")
    quarter = F.floor(n / 4).cast("int")
    docs = docs.withColumn("q", quarter).withColumn("cut", n - F.col("q"))
    docs = docs.withColumn("edited", F.concat(F.substring("text", F.lit(1), F.col("cut")), F.substring(F.coalesce(F.lead("text").over(follow), F.lit("")), F.lit(1), F.col("q"))))
    # The shared words end with the last space before the cut.
    head = F.substring("text", F.lit(1), F.col("cut"))
    docs = docs.withColumn("same", F.col("cut") - F.instr(F.reverse(head), " ") + 1).withColumn("same", F.when(F.instr(head, " ") == 0, F.lit(0)).otherwise(F.col("same")))
    rest = lambda c: F.substring(F.col(c), F.col("same") + 1, F.length(c))
    docs = docs.select(
        "doc_id", "__run", "__ghost", "__tie", n.cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        word_hashes(F.substring("text", F.lit(1), F.col("same"))).alias("w"), word_hashes(rest("text")).alias("wt"), word_hashes(rest("edited")).alias("we"),
    )
    # Shingles that begin in the shared words and end beyond them need its last four words.
    last = F.slice(F.col("w"), F.greatest(F.size("w") - (SHINGLE - 2), F.lit(1)), F.lit(SHINGLE - 1))
    docs = docs.withColumn("wt", F.concat(last, "wt")).withColumn("we", F.concat(last, "we"))
    alone = lambda c: (F.size("w") >= SHINGLE) & (F.size(c) < SHINGLE)  # noqa: E731 - too short beyond the cut for a shingle
    none = F.array().cast("array<bigint>")
    docs = docs.withColumn("h", F.when(F.size("w") >= SHINGLE, shingle_hashes(F.col("w"))).otherwise(none))
    for c in ("wt", "we"):
        docs = docs.withColumn(c, F.when(alone(c), none).otherwise(shingle_hashes(F.col(c))))
    docs = with_bins(docs, F.concat("h", "wt"), "bins").drop("wt")
    docs = with_bins(docs, F.concat("h", "we"), "edited_bins").drop("we", "h", "w")
    docs = docs.withColumn("next_bins", F.lead("bins").over(follow)).where("__ghost = 0")
    return docs.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        packed(F.col("bins")).alias("fingerprint"),
        packed(F.col("edited_bins")).alias("edited_fingerprint"),
        likeness(F.col("bins"), F.col("edited_bins")).alias("near_edited"),
        likeness(F.col("bins"), F.col("next_bins")).alias("near_next"),
    )
