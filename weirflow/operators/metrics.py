"""Label shares, weights and classification quality; each from one small aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from weirflow.operators.sampling import CLASSES
from weirflow.schema import LABEL


def label_distribution(df: DataFrame, label: str = LABEL) -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("n"))


def label_share(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Total, normal and attack counts with percentages to one decimal."""
    counted = df.agg(
        F.count("*").alias("total"),
        F.count_if(F.col(label) == 0).alias("normal"),
        F.count_if(F.col(label) == 1).alias("attack"),
    )
    percent = {c: F.round(F.lit(100.0) * F.col(c) / F.col("total"), 1) for c in ("normal", "attack")}
    return counted.select("*", *(p.alias(f"{c}_percent") for c, p in percent.items()))


def class_weights(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Balanced weight per class: rows / (classes * rows of the class)."""
    counts = df.filter(F.col(label).isin(*CLASSES)).groupBy(label).agg(F.count("*").alias("n"))
    everything = W.partitionBy(F.lit(1))
    weight = F.sum("n").over(everything) / (F.count("*").over(everything) * F.col("n"))
    return counts.select(label, "n", weight.alias("weight"))


def confusion_matrix(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """tn, fp, fn, tp over the fixed labels 0 and 1."""
    truth, guess = F.col(label), F.col(prediction)
    return df.agg(
        F.count_if((truth == 0) & (guess == 0)).alias("tn"),
        F.count_if((truth == 0) & (guess == 1)).alias("fp"),
        F.count_if((truth == 1) & (guess == 0)).alias("fn"),
        F.count_if((truth == 1) & (guess == 1)).alias("tp"),
    )


def _ratio(part: Column, whole: Column) -> Column:
    """An empty denominator counts as zero."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(part / whole)


def classification_report(df: DataFrame, label: str, prediction: str, decimals: int = 6) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy and both averages."""
    m = confusion_matrix(df, label, prediction)
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    rated = m.select(
        (tn + fp).alias("normal_n"), (fn + tp).alias("attack_n"),
        _ratio(tn, tn + fn).alias("normal_p"), _ratio(tn, tn + fp).alias("normal_r"),
        _ratio(2 * tn, 2 * tn + fn + fp).alias("normal_f"),
        _ratio(tp, tp + fp).alias("attack_p"), _ratio(tp, tp + fn).alias("attack_r"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("attack_f"),
        _ratio(tn + tp, tn + fp + fn + tp).alias("accuracy"),
    )
    total = F.col("normal_n") + F.col("attack_n")

    def row(name: str, p: Column, r: Column, f: Column, n: Column) -> Column:
        rounded = [F.round(c, decimals).alias(k) for c, k in ((p, "precision"), (r, "recall"), (f, "f1"))]
        return F.struct(F.lit(name).alias("class"), *rounded, n.alias("support"))

    def macro(x: str) -> Column:
        return (F.col(f"normal_{x}") + F.col(f"attack_{x}")) / 2

    def weighted(x: str) -> Column:
        parts = F.col(f"normal_{x}") * F.col("normal_n") + F.col(f"attack_{x}") * F.col("attack_n")
        return _ratio(parts, total)

    accuracy, blank = F.col("accuracy"), F.lit(None).cast("double")
    rows = [
        *(
            row(name.capitalize(), *(F.col(f"{name}_{x}") for x in "prf"), F.col(f"{name}_n"))
            for name in ("normal", "attack")
        ),
        row("accuracy", blank, blank, accuracy, total),
        row("macro avg", *(macro(x) for x in "prf"), total),
        row("weighted avg", *(weighted(x) for x in "prf"), total),
    ]
    return rated.select(F.inline(F.array(*rows)))


def top_signals(df: DataFrame, features: list[str], k: int = 10, label: str = LABEL) -> DataFrame:
    """Features whose mean shifts most between the classes, in standard deviations."""
    stats = []
    for f in features:
        value = F.coalesce(F.col(f).cast("double"), F.lit(0.0))
        attack = F.avg(F.when(F.col(label) == 1, value))
        normal = F.avg(F.when(F.col(label) == 0, value))
        shift = F.abs(attack - normal) / F.stddev_pop(F.when(F.col(label).isin(*CLASSES), value))
        stats.append(F.round(shift, 6).alias(f))
    ranked = df.agg(*stats).unpivot([], features, "feature", "shift")
    return ranked.orderBy(F.desc("shift"), "feature").limit(k)
