"""Language by Bayesian fusion of text, declared language, address suffix and host.

Each row gets log-likelihoods of its text under byte-trigram models of the known
languages and a flat model of "other". Grouped aggregation over all rows then
learns how declared languages and address suffixes go with the languages of texts,
and a prior for every host: its own counts, smoothed by those of its domain, and
these by those of all rows. Bayes' rule joins the four.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from millrace.llm.batches import LOWER, SMALL_SLICE, mix, slices, text_bytes
from millrace.session import stage

OTHER = "other"
BUCKETS = 1 << 14
#: Texts per language that the trigram models are fitted on, those whose id hashes lowest.
MAX_TEXTS = 2_000
#: Neighbouring trigrams depend on each other: a text never weighs more than so many independent ones.
EFFECTIVE = 60.0
#: Share of "other" before any evidence, and weight of the level above in counts of rows.
OTHER_SHARE = 0.002
SMOOTHING = 5.0


def trigrams(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every trigram with two letters or more, and the row of each; none spans two rows.

    All bytes but letters count as a space, so that marks and digits are not evidence.
    """
    if len(data) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    lower = LOWER[data]
    letter = ((lower >= 97) & (lower <= 122)) | (lower >= 128)
    lower = np.where(letter, lower, np.uint8(32))
    count = letter.astype(np.int8)
    at = np.flatnonzero(count[:-2] + count[1:-1] + count[2:] >= 2)
    row = np.searchsorted(bounds, at, side="right") - 1
    inside = at + 2 < bounds[row + 1]
    at, row = at[inside], row[inside]
    wide = lower.astype(np.uint64)
    code = wide[at] << np.uint64(16) | wide[at + 1] << np.uint64(8) | wide[at + 2]
    return (mix(code) % np.uint64(BUCKETS)).astype(np.int64), row


class TrigramModel:
    """Log-probabilities of the buckets in each language and, last, in a flat "other"."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = [*languages, OTHER]
        smooth = (counts + 0.5) / (counts.sum(1, keepdims=True) + 0.5 * BUCKETS) if len(languages) else np.zeros((0, BUCKETS))
        self.logs = np.log(np.concatenate([smooth, np.full((1, BUCKETS), 1.0 / BUCKETS)])).astype(np.float32)

    def likelihoods(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Mean log-likelihood per trigram (rows by languages), and the number of trigrams."""
        bucket, row = trigrams(data, bounds)
        n = np.bincount(row, minlength=len(bounds) - 1)
        sums = [np.bincount(row, weights=log[bucket], minlength=len(n)) for log in self.logs]
        return np.stack(sums, 1) / np.maximum(n, 1)[:, None], n


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> TrigramModel:
    """Trigram models from texts with a known language, at most MAX_TEXTS of each.

    Rows whose language or text is null, or language is empty or "other", are not used.
    """
    named = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & ~F.col(lang_col).isin("", OTHER))
    picked = named.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.xxhash64(id_col, text_col).alias("h"))
    order = W.partitionBy("lang").orderBy("h", "id")
    picked = picked.withColumn("n", F.row_number().over(order)).where(F.col("n") <= MAX_TEXTS).select("id", "h")
    texts = named.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    chosen = texts.withColumn("h", F.xxhash64("id", "text")).join(F.broadcast(picked.distinct()), ["id", "h"])

    def count(batches):
        for batch in batches:
            for part in slices(batch, "text", SMALL_SLICE):
                names = np.asarray(part.column("lang").to_pylist())
                bucket, row = trigrams(*text_bytes(part.column("text")))
                for lang in np.unique(names):
                    n = np.bincount(bucket[names[row] == lang], minlength=BUCKETS)
                    hit = np.flatnonzero(n)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([str(lang)] * len(hit), pa.string()), pa.array(hit), pa.array(n[hit])], names=["lang", "bucket", "n"]
                    )

    counted = chosen.select("lang", "text").mapInArrow(count, "lang string, bucket long, n long")
    table = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(table["lang"].unique())
    counts = np.zeros((len(languages), BUCKETS))
    counts[[languages.index(x) for x in table["lang"]], table["bucket"]] = table["n"]
    return TrigramModel(languages, counts)


def _shares(weights: Column, size: int) -> Column:
    """An array of log-weights as shares of one."""
    top = F.array_max(weights)
    scaled = F.transform(weights, lambda w: F.exp(w - top))
    total = F.aggregate(scaled, F.lit(0.0), lambda a, x: a + x)
    return F.transform(scaled, lambda x: x / total)


def _sums(size: int) -> list[Column]:
    return [F.sum(F.col("by_text")[i]).alias(f"s{i}") for i in range(size)]


def _smoothed(size: int, above: str) -> Column:
    """Counts s0.. of a level with SMOOTHING rows shared as in the level above."""
    total = sum((F.col(f"s{i}") for i in range(1, size)), F.col("s0"))
    return F.array(*[(F.col(f"s{i}") + SMOOTHING * F.col(above)[i]) / (total + SMOOTHING) for i in range(size)])


def identify(rows: DataFrame, model: TrigramModel, at_least: float = 0.5) -> DataFrame:
    """lang, probability and accepted of every row of (id, text, declared, suffix, host).

    A row is accepted if its language is a known one with a probability of
    ``at_least``. Null, empty and letterless texts carry no evidence and are never
    accepted, whatever their host says. A null or empty ``declared``, ``suffix`` or
    ``host`` leaves that evidence out. Repeated rows and null ids are kept, ties go
    to the language first in the alphabet, an empty table gives no rows.
    """
    size = len(model.languages)
    wanted = rows.select(
        "id", "text", F.lower("declared").alias("declared"), F.lower("suffix").alias("suffix"), F.lower("host").alias("host")
    )
    id_type = wanted.schema["id"].dataType.simpleString()

    def weigh(batches):
        for batch in batches:
            for part in slices(batch, "text", SMALL_SLICE):
                mean, n = model.likelihoods(*text_bytes(part.column("text")))
                weight = mean * np.minimum(n, EFFECTIVE)[:, None]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("declared"), part.column("suffix"), part.column("host"),
                     pa.array(n.astype(np.int64)), pa.array(list(weight.astype(float)), pa.list_(pa.float64()))],
                    names=["id", "declared", "suffix", "host", "n", "log_text"],
                )

    weighed = stage(
        wanted.mapInArrow(weigh, f"id {id_type}, declared string, suffix string, host string, n long, log_text array<double>"),
        "language-evidence",
    )
    flat = [np.log((1 - OTHER_SHARE) / max(size - 1, 1))] * (size - 1) + [np.log(OTHER_SHARE)]
    start = F.array(*[F.lit(float(x)) for x in flat])
    by_text = _shares(F.zip_with("log_text", start, lambda a, b: a + b), size)
    domain = F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1)
    base = weighed.withColumn("by_text", by_text).withColumn("domain", F.when(F.col("host") != "", F.when(domain != "", domain).otherwise(F.col("host"))))
    telling = base.where("n > 0")

    # every level of the host prior from the same grouped counts
    hosts = stage(telling.where("domain is not null").groupBy("domain", "host").agg(*_sums(size)), "hosts")
    again = [F.sum(f"s{i}").alias(f"s{i}") for i in range(size)]
    even = F.array(*[F.lit(float(np.exp(x))) for x in flat])
    overall = telling.agg(*_sums(size)).select(*[F.coalesce(f"s{i}", F.lit(0.0)).alias(f"s{i}") for i in range(size)])
    overall = overall.withColumn("even", even).select(_smoothed(size, "even").alias("overall")).first()["overall"]
    overall = F.array(*[F.lit(float(x)) for x in overall])
    domains = hosts.groupBy("domain").agg(*again).withColumn("overall", overall).select("domain", _smoothed(size, "overall").alias("above"))
    priors = hosts.join(domains, "domain").select("host", _smoothed(size, "above").alias("prior"))

    def factors(column: str) -> DataFrame:
        """log P(value | language) / P(value) of each value of a column, smoothed towards no effect."""
        counts = telling.where(F.col(column) != "").groupBy(column).agg(*_sums(size)).withColumn("overall", overall)
        share = _smoothed(size, "overall")
        return counts.select(column, F.zip_with(share, "overall", lambda a, b: F.log(a / b)).alias(f"{column}_gain"))

    nothing = F.array(*[F.lit(0.0)] * size)
    joined = base.join(stage(priors, "host-priors"), "host", "left")
    for column in ("declared", "suffix"):
        joined = joined.join(stage(factors(column), f"{column}-factors"), column, "left")
    total = F.transform(F.coalesce("prior", overall), lambda p: F.log(p))
    for part in (F.col("log_text"), F.coalesce("declared_gain", nothing), F.coalesce("suffix_gain", nothing)):
        total = F.zip_with(total, part, lambda a, b: a + b)
    posterior = joined.select("id", "n", _shares(total, size).alias("posterior"))
    best = F.array_position("posterior", F.array_max("posterior")).cast("int")
    names = F.array(*[F.lit(x) for x in model.languages])
    lang = F.when(F.col("n") > 0, names[best - 1]).otherwise(F.lit(OTHER))
    probability = F.when(F.col("n") > 0, F.array_max("posterior")).otherwise(F.lit(0.0))
    return posterior.select("id", lang.alias("lang"), probability.alias("probability")).withColumn(
        "accepted", (F.col("lang") != OTHER) & (F.col("probability") >= at_least)
    )


def page_rows(pages: DataFrame) -> DataFrame:
    """id, text, declared, suffix and host of web pages (page_id, url, html).

    The text is what is left of the markup without scripts, styles, comments and
    tags; the declared language is the ``lang`` attribute of ``html`` without its
    region; the suffix is the last label of the host.
    """
    html = F.coalesce("html", F.lit(""))
    text = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    host = F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1)
    declared = F.regexp_extract(html, r"(?i)<html[^>]*\blang\s*=\s*[\"']?([A-Za-z]{2,3})", 1)
    return pages.select(
        F.col("page_id").alias("id"), text.alias("text"), declared.alias("declared"),
        F.regexp_extract(host, r"\.([^.]+)$", 1).alias("suffix"), host.alias("host"),
    )
