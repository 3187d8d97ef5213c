"""Learned encoders (survey 2.9): fit on a DataFrame, transform with built-in
expressions or Spark ML stages.

What a fit keeps on the driver is always bounded by a parameter or a
vocabulary: quantile edges (n + 1 numbers), per-bin means (n rows), label
vocabularies of categorical columns, PCA loadings (vocabulary x k).
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from typing import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import (CountVectorizer, ElementwiseProduct, IDF, Normalizer, PCA,
                                RegexTokenizer, StandardScaler)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.quantiles import quantiles
from ..functions.scalars import round_half_even
from ..operators.prefix import Agg, running

LABEL = "answered_correctly"


# ---------------------------------------------------------------- quantile bins

def quantile_edges(df: DataFrame, col: str, n: int, tolerance: float = 1e-12) -> list[float]:
    """n quantile bins -> rising edges; edges that differ by no more than
    rounding errors (``tolerance`` of the range) are one (D17)."""
    qs = sorted(q for q in quantiles(df, col, [k / n for k in range(n + 1)]) if q is not None)
    gap = tolerance * (qs[-1] - qs[0]) if qs and math.isfinite(qs[-1] - qs[0]) else 0.0
    edges: list[float] = []
    for q in qs:
        if not edges or q - edges[-1] > gap:
            edges.append(q)
    return edges


def bin_index(x: str | Column, edges: Sequence[float], right_closed: bool = False) -> Column:
    """Bin number 0..len(edges)-2 by counting inner edges.

    Left-closed bins [e_i, e_i+1) count inner edges <= x (the quantile
    binner); right-closed bins (e_i, e_i+1] count inner edges < x (qcut).
    Values outside the range fall in the first / last bin. NULL stays NULL.
    """
    c = F.col(x) if isinstance(x, str) else x
    inner = [float(e) for e in edges[1:-1]]

    def search(lo: int, hi: int) -> Column:
        """Number of inner edges below ``c``, known to lie in lo..hi: a binary search."""
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        over = c > inner[mid] if right_closed else c >= inner[mid]
        return F.when(over, search(mid + 1, hi)).otherwise(search(lo, mid))

    return F.when(c.isNotNull(), search(0, len(inner))).cast("int")


@dataclass
class QuantileTargetEncoder:
    """Fit: quantile bins of ``col`` over all rows, mean label per bin over
    labelled rows. Transform: bin -> mean; an unseen bin gets the global mean."""

    n: int = 50
    col: str = "timestamp"
    out: str = "tbins_qauc_encode"
    edges: list[float] = field(default_factory=list)
    table: DataFrame | None = None
    global_mean: float | None = None

    def fit(self, df: DataFrame) -> "QuantileTargetEncoder":
        self.edges = quantile_edges(df, self.col, self.n)
        lab = df.filter(F.col(LABEL) != -1).withColumn("ts_bin", bin_index(self.col, self.edges))
        # At most n rows: a bounded table that is safe to broadcast; the log is read once for it.
        sums = lab.groupBy("ts_bin").agg(F.sum(LABEL).alias("s"), F.count(LABEL).alias("n")).collect()
        self.table = df.sparkSession.createDataFrame([(r["ts_bin"], r["s"] / r["n"]) for r in sums], f"ts_bin int, {self.out} double")
        rows = sum(r["n"] for r in sums)
        self.global_mean = sum(r["s"] for r in sums) / rows if rows else None
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        b = df.withColumn("ts_bin", bin_index(self.col, self.edges))
        j = b.join(F.broadcast(self.table), "ts_bin", "left")
        return j.withColumn(self.out, F.coalesce(F.col(self.out), F.lit(self.global_mean)))


def bin_label_counts(binned: DataFrame, bin_col: str = "ts_bin") -> DataFrame:
    """Rows by (bin, label) pivoted to columns c0 / c1 (labelled rows only)."""
    lab = binned.filter(F.col(LABEL) != -1)
    p = lab.groupBy(bin_col).pivot(LABEL, [0, 1]).count()
    return p.select(bin_col, F.coalesce(F.col("0"), F.lit(0)).cast("long").alias("c0"),
                    F.coalesce(F.col("1"), F.lit(0)).cast("long").alias("c1"))


def time_bin_cluster(df: DataFrame, n: int = 200, col: str = "timestamp") -> tuple[DataFrame, list[float]]:
    """Per qcut bin (right-closed): rate = round(c1 / (c0 + c1), 2); rates
    above the median of rates become 1; cluster = rank of the distinct value.

    Returns (bin -> ts_cluster table of at most n rows, edges)."""
    edges = quantile_edges(df, col, n)
    counts = bin_label_counts(df.withColumn("ts_bin", bin_index(col, edges, right_closed=True)))
    # The per-bin table has at most n rows (bounded by the parameter); the log is read once for it.
    counts = df.sparkSession.createDataFrame(counts.collect(), counts.schema)
    rate = counts.withColumn("rate", round_half_even(F.try_divide(F.col("c1").cast("double"),
                                                                  (F.col("c0") + F.col("c1")).cast("double")), 2))
    med = rate.agg(F.median("rate")).first()[0]
    capped = rate.withColumn("v", F.when(F.col("rate") > F.lit(med), F.lit(1.0)).otherwise(F.col("rate")))
    codes = capped.select("v").distinct().withColumn(
        "ts_cluster", (F.dense_rank().over(Window.orderBy("v")) - 1).cast("int"))
    return capped.join(codes, "v", "left").select("ts_bin", "c0", "c1", "rate", "ts_cluster"), edges


# ---------------------------------------------------------------- label codes

def label_encode(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Sorted distinct values -> 0..k-1 (NULL stays NULL): distinct values, a
    running count over them, joined back. No vocabulary on the driver."""
    o = out or f"{col}_enc"
    vals = df.select(F.col(col).alias("_v")).where(F.col("_v").isNotNull()).distinct()
    codes = running(vals, [], [Agg(o, "count", F.lit(1))], order=("_v",))
    codes = codes.withColumn(o, F.col(o).cast("int")).withColumnRenamed("_v", col)
    return df.join(codes, col, "left")


def auto_categorical(df: DataFrame, cols: Sequence[str], max_levels: int = 200,
                     key: str = "row_id", train: Column | None = None) -> tuple[DataFrame, dict]:
    """Text columns and columns with fewer than ``max_levels`` distinct values
    are label-encoded, with a level of their own for NULL if there are any;
    other numeric columns get NULL -> mean (D10: each column its own mean),
    the mean over the rows where ``train`` holds (all rows without it).

    Returns the frame and {column: (position among ``cols``, levels)} of the
    encoded ones: the categorical positions and dims. Counts are exact.
    """
    types = dict(df.dtypes)
    stats = df.agg(*[F.countDistinct(c).alias(f"d_{c}") for c in cols],
                   *[F.max(F.col(c).isNull().cast("int")).alias(f"n_{c}") for c in cols]).first()
    cat = [c for c in cols if types[c] == "string" or stats[f"d_{c}"] < max_levels]
    num = [c for c in cols if c not in cat]
    seen = F.lit(True) if train is None else train
    means = df.agg(*[F.avg(F.when(seen, F.col(c))).alias(c) for c in num]).first().asDict() if num else {}
    out, dims = df.select(key, *cols), {}
    for c in cat:
        missing = stats[f"n_{c}"] or 0
        if types[c] == "string":
            out = label_encode(out.withColumn(c, F.coalesce(F.col(c), F.lit("missing"))), c)
            dims[c] = (list(cols).index(c), out.select(F.countDistinct(c)).first()[0] if missing else stats[f"d_{c}"])
        else:
            # the level after the last one is that of NULL
            out = label_encode(out, c).withColumn(f"{c}_enc", F.coalesce(F.col(f"{c}_enc"), F.lit(stats[f"d_{c}"])).cast("int"))
            dims[c] = (list(cols).index(c), stats[f"d_{c}"] + missing)
    out = out.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(means[c])) for c in num}) if num else out
    return out, dims


# ---------------------------------------------------------------- tags TF-IDF + PCA

# Tags are numbers of the question table: a vocabulary beyond this is an error, not cut off.
VOCABULARY = 1 << 20
TOKEN_PATTERN = r"\w\w+"  # tokens of two or more word characters (one-character tags drop, D5)


@dataclass
class TagsEncoder:
    """tags text -> TF-IDF (smoothed idf + 1, L2 rows) -> centred PCA scores
    ``PCA_0..PCA_{k-1}`` with a fixed sign (largest-magnitude loading > 0)."""

    k: int = 5
    col: str = "tags"
    vocab: list[str] = field(default_factory=list)
    _tf: object = None
    _scale: object = None
    _center: object = None
    _pca: object = None
    _sign: DenseVector | None = None

    def fit(self, df: DataFrame) -> "TagsEncoder":
        docs = df.withColumn("_doc", F.coalesce(F.col(self.col), F.lit(" ")))
        tf = Pipeline(stages=[
            RegexTokenizer(inputCol="_doc", outputCol="_tok", pattern=TOKEN_PATTERN, gaps=False),
            CountVectorizer(inputCol="_tok", outputCol="_tf", vocabSize=VOCABULARY)]).fit(docs)
        self._tf = tf
        self.vocab = list(tf.stages[1].vocabulary)
        if len(self.vocab) == VOCABULARY:
            raise ValueError(f"{VOCABULARY} tags or more; raise VOCABULARY")
        counts = tf.transform(docs)
        idf = IDF(inputCol="_tf", outputCol="_idf_unused").fit(counts).idf.toArray()
        self._scale = ElementwiseProduct(inputCol="_tf", outputCol="_w",
                                         scalingVec=DenseVector(idf + 1.0))
        tfidf = self._weights(counts)
        self._center = StandardScaler(inputCol="_tfidf", outputCol="_c", withMean=True,
                                      withStd=False).fit(tfidf)
        centred = self._center.transform(tfidf)
        k = min(self.k, len(self.vocab)) or 1
        self._pca = PCA(k=k, inputCol="_c", outputCol="_pca").fit(centred)
        pc = self._pca.pc.toArray()
        sign = [1.0 if pc[abs(pc[:, j]).argmax(), j] >= 0 else -1.0 for j in range(pc.shape[1])]
        self._sign = DenseVector(sign)
        return self

    def _weights(self, counts: DataFrame) -> DataFrame:
        w = self._scale.transform(counts)
        return Normalizer(inputCol="_w", outputCol="_tfidf", p=2.0).transform(w)

    def tfidf(self, df: DataFrame) -> DataFrame:
        docs = df.withColumn("_doc", F.coalesce(F.col(self.col), F.lit(" ")))
        return self._weights(self._tf.transform(docs))

    def tfidf_long(self, df: DataFrame, key: str) -> DataFrame:
        """(key, token, weight) for the non-zero TF-IDF weights: the tokens of a
        row, not the vocabulary, are exploded."""
        tok = RegexTokenizer(inputCol="_doc", outputCol="_tok", pattern=TOKEN_PATTERN, gaps=False)
        docs = tok.transform(df.withColumn("_doc", F.coalesce(F.col(self.col), F.lit(" "))))
        idf = self._scale.getScalingVec().toArray()
        table = df.sparkSession.createDataFrame([(t, float(w)) for t, w in zip(self.vocab, idf)] or [("", 0.0)], "token string, _idf double")
        # tokens of a row: a handful, so a row's weights are put together in the row
        tf = docs.select(key, F.explode("_tok").alias("token")).groupBy(key, "token").agg(F.count(F.lit(1)).alias("_n"))
        w = tf.join(table, "token").withColumn("_w", F.col("_n") * F.col("_idf"))
        norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(key)))
        return w.select(key, "token", (F.col("_w") / norm).alias("weight"))

    def transform(self, df: DataFrame) -> DataFrame:
        t = self._center.transform(self.tfidf(df))
        p = self._pca.transform(t)
        p = ElementwiseProduct(inputCol="_pca", outputCol="_pcs", scalingVec=self._sign).transform(p)
        arr = vector_to_array("_pcs")
        n = len(self._sign)
        out = p.withColumns({f"PCA_{i}": arr[i] for i in range(n)})
        return out.drop("_doc", "_tok", "_tf", "_w", "_tfidf", "_c", "_pca", "_pcs")
