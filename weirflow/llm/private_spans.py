"""PII: labelers vote on candidate spans, expectation-maximisation weighs them, a span classifier decides.

Only DataFrame functions; the texts are read once and never moved. Per document the candidates are found
with regular expressions that take linear time and constant stack also on very long runs.
Positions come from splitting the text at the same pattern. Four kinds of base spans
(email, ip, card, phone) always stay. Loose candidates (a phone number without its plus sign, a spelled-out
address) are added when the trained classifier says so.

Labelers: the strict form (``regex``), known endings, issuer prefixes and reserved networks (``gazetteer``),
words just before the span (``context``). A vote is 1, 0 or -1 for no opinion. The votes of all documents are
counted per kind and pattern (at most 4 x 27 rows), from which expectation-maximisation estimates how often
each labeler is right. Each candidate's posterior is the soft label of a naive Bayes classifier
over span features (at most a few hundred weights).

Null text: counted as empty, no spans. Null ``doc_id``: the row stays, its id null. Repeated rows: one result
row each. Overlapping kinds are all reported. Columns besides id and text are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weirflow.llm.tables import table, whole_text
from weirflow.session import scratch_path

KINDS = ("email", "ip", "card", "phone")
ADD_FROM = 0.9
EM_ROUNDS = 50
NEAR = 40  # characters before a span that count as its context

#: Single separators between two allowed characters become U+0001 first, so that one character class
#: takes a whole run: no repeated groups, no deep recursion. U+0001 in the text itself becomes U+0002.
MARK = "\x01"
_ADDRESS = f"A-Za-z0-9._%+{MARK}-"
#: An address begins where its run of characters begins, or where the last match ended.
EMAIL = rf"(?:(?<![{_ADDRESS}])|\G)[{_ADDRESS}]++@[A-Za-z0-9-]++{MARK}[A-Za-z0-9{MARK}-]++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = f"[0-9][0-9{MARK}]+"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
LOOSE_PHONE = r"(?<![0-9+.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])"
LOOSE_EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?[(\[]at[)\]] ?[A-Za-z0-9-]{1,63}(?: ?[(\[]dot[)\]] ?|\.)[A-Za-z]{2,24}"
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
IP_IN_RANGE = rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$"

#: Common top-level domains, words that announce a span, words that speak against it.
ENDINGS = ("com", "org", "net", "edu", "gov", "io", "de", "fr", "es", "uk", "eu", "info")
ANNOUNCE = {
    "email": r"(?i)(e-?mail|contact|write to|@)",
    "ip": r"(?i)\b(ip|address|host|server|login)\b",
    "card": r"(?i)\b(card|visa|master|credit|pay)",
    "phone": r"(?i)\b(tel|phone|call|fax|mobile|contact)",
}
SPEAK_AGAINST = r"(?i)\b(version|isbn|issn|order|section|part|sku|rev)\b[^A-Za-z]*$"


_SPANS = "array<struct<start:int,end:int,value:string>>"
_BLOCK = 256


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _running(numbers: Column) -> Column:
    """Sum of all numbers before each one; linear, block by block."""

    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0), lambda a, x: a + x)

    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(numbers) - 1) / _BLOCK).cast("int")),
        lambda b: total(F.slice(numbers, b * _BLOCK + 1, F.lit(_BLOCK))),
    )
    before = F.aggregate(blocks, F.array(F.lit(0)), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))

    def place(starts: Column) -> Column:
        def one(_: Column, i: Column) -> Column:
            block = F.floor(i / _BLOCK).cast("int")
            return F.element_at(starts, block + 1) + total(F.slice(numbers, block * _BLOCK + 1, i % _BLOCK))

        return F.transform(numbers, one)

    return _let(before, place)


def _spans(text: Column, pattern: str) -> Column:
    """All matches with their code points: what lies between them comes from splitting at the same pattern."""

    def build(both: Column) -> Column:
        found, gaps = both["found"], both["gaps"]
        steps = F.transform(found, lambda v, i: F.length(v) + F.length(F.element_at(gaps, i + 1)))

        def spans(offsets: Column) -> Column:
            def one(v: Column, i: Column) -> Column:
                start = F.element_at(offsets, i + 1) + F.length(F.element_at(gaps, i + 1))
                return F.struct(start.alias("start"), (start + F.length(v)).alias("end"), v.alias("value"))

            return F.transform(found, one)

        placed = _let(steps, lambda n: _let(_running(n), spans))
        return F.when(F.size(found) == 0, F.array().cast(_SPANS)).otherwise(placed)

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found")
    return _let(F.struct(found, F.split(text, pattern, -1).alias("gaps")), build)


def _if(condition: Column, spans: Column) -> Column:
    return F.when(condition, spans).otherwise(F.array().cast(_SPANS))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the check digit fits."""

    def weighted(c: Column, i: Column) -> Column:
        d = c.cast("int")
        return F.when(i % 2 == 0, d).when(d < 5, d * 2).otherwise(d * 2 - 9)

    places = F.transform(F.split(F.reverse(digits), ""), weighted)
    return F.aggregate(places, F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(IP_IN_RANGE)
    if kind == "card":
        return F.when(F.length(_digits(value)).between(16, 19), _luhn(_digits(value))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    return F.lit(True)


def _candidates(kind: str, loose: bool) -> Column:
    """Matches of a kind in the column ``text``, valid or not."""
    text = F.translate("text", MARK, "\x02")
    if kind == "email" and not loose:
        marked = F.regexp_replace(text, r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])", MARK)
        return _if(F.col("text").contains("@"), _spans(marked, EMAIL))
    if kind == "email":
        return _if(F.col("text").rlike(r"[(\[]at[)\]]"), _spans(text, LOOSE_EMAIL))
    if kind == "ip":
        return _if(F.col("text").rlike(r"[0-9]\.[0-9]"), _spans(text, IP))
    if kind == "card":
        marked = F.regexp_replace(text, "(?<=[0-9])[ -](?=[0-9])", MARK)
        # Shorter runs of digits are no candidates at all.
        long_runs = F.filter(_spans(marked, CARD), lambda x: F.length(x["value"]) >= 13)
        return _if(F.col("text").rlike("[0-9](?:[ -]?[0-9]){12}"), long_runs)
    pattern = LOOSE_PHONE if loose else PHONE
    check = r"[0-9]{3}[ .-][0-9]{4}" if loose else r"\+[0-9]"
    return _if(F.col("text").rlike(check), _spans(text, pattern))


def _gazetteer(kind: str, value: Column) -> Column:
    digits = _digits(value)
    if kind == "email":
        return F.when(F.lower(value).rlike(f"(?:{'|'.join(ENDINGS)})$"), 1).otherwise(-1)
    if kind == "ip":
        return F.when(value.rlike(r"^(?:0|127|255|22[4-9]|23[0-9])\."), 0).otherwise(-1)
    if kind == "card":
        return F.when(digits.rlike("^(?:4|5[1-5]|2[2-7]|3[47]|6)"), 1).otherwise(0)
    return F.when(digits.rlike("555"), 1).otherwise(-1)


def _described(kind: str, loose: bool, spans: Column) -> Column:
    """Candidates with their votes and features."""

    def one(x: Column) -> Column:
        start, end, value = x["start"], x["end"], x["value"]
        first = F.greatest(start - NEAR, F.lit(0))
        left = F.substring(F.col("text"), first + 1, start - first)
        right = F.substring(F.col("text"), end + 1, F.lit(1))
        context = F.when(left.rlike(SPEAK_AGAINST), 0).when(left.rlike(ANNOUNCE[kind]), 1).otherwise(-1)
        regex = F.lit(0) if loose else _valid(kind, value).cast("int")
        gazetteer = _gazetteer(kind, F.translate(value, MARK, "."))
        edge = F.when(right == "", "end").when(right.rlike(r"^\s"), "space").when(right.rlike("^[A-Za-z0-9]"), "word")
        features = F.array(
            F.concat(F.lit("digits "), F.least(F.length(_digits(value)), F.lit(20)).cast("string")),
            F.concat(F.lit("separators "), F.least(F.length(F.regexp_replace(value, "[A-Za-z0-9]", "")), F.lit(6)).cast("string")),
            F.concat(F.lit("right "), edge.otherwise("mark")),
            F.concat(F.lit("left "), F.when(left.rlike(r"\s$"), "space").when(left == "", "start").otherwise("other")),
            F.concat(F.lit("context "), context.cast("string")),
            F.concat(F.lit("gazetteer "), gazetteer.cast("string")),
        )
        return F.struct(
            F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), F.lit(loose).alias("loose"),
            F.array(regex, gazetteer, context).alias("votes"), features.alias("features"),
        )

    return F.transform(spans, one)


def candidate_table(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and the column ``candidates``; the only step that reads texts."""
    kinds = [(kind, False) for kind in KINDS] + [("email", True), ("phone", True)]
    every = F.concat(*(_described(kind, loose, _candidates(kind, loose)) for kind, loose in kinds))
    return docs.select(*keep, every.alias("candidates"))


def reliabilities(patterns: list[tuple[str, tuple[int, ...], int]]) -> dict[tuple[str, tuple[int, ...]], float]:
    """Posterior of every vote pattern by expectation-maximisation; kinds have their own priors and labelers.

    ``patterns``: (kind, votes, how often); one number per kind and pattern, whatever the corpus.
    """
    posterior: dict[tuple[str, tuple[int, ...]], float] = {}
    for kind in {k for k, _, _ in patterns}:
        own = [(votes, n) for k, votes, n in patterns if k == kind]
        labelers = len(own[0][0])
        # Labelers are believed to be right eight times in ten at first; the same belief smooths the estimates.
        right = [[0.8, 0.8] for _ in range(labelers)]
        prior = 0.5
        for _ in range(EM_ROUNDS):
            weights = []
            for votes, n in own:
                yes, no = prior, 1 - prior
                for (hit, reject), vote in zip(right, votes, strict=True):
                    if vote >= 0:
                        yes *= hit if vote else 1 - hit
                        no *= 1 - reject if vote else reject
                weights.append((votes, n, yes / (yes + no)))
            total = sum(n for _, n, _ in weights)
            prior = (sum(n * p for _, n, p in weights) + 1) / (total + 2)
            for j in range(labelers):
                spoken = [(v[j], n, p) for v, n, p in weights if v[j] >= 0]
                yes, no = sum(n * p for _, n, p in spoken), sum(n * (1 - p) for _, n, p in spoken)
                right[j][0] = (sum(n * p for v, n, p in spoken if v) + 8) / (yes + 10)
                right[j][1] = (sum(n * (1 - p) for v, n, p in spoken if not v) + 8) / (no + 10)
        posterior.update({(kind, votes): p for votes, _, p in weights})
    return posterior


def _log_odds(yes: float, no: float, yes_all: float, no_all: float) -> float:
    return math.log((yes + 1) / (yes_all + 2)) - math.log((no + 1) / (no_all + 2))


def train(candidates: DataFrame) -> dict[tuple[str, str], float]:
    """Weight of every (kind, feature) of the span classifier; the feature ``""`` is the bias.

    What reaches the driver is one row per kind and vote pattern, or per kind, pattern and feature: under 3000 rows.
    """
    spans = candidates.select(F.explode("candidates").alias("c")).select(
        F.col("c.kind").alias("kind"), F.col("c.votes").alias("votes"), F.col("c.features").alias("features")
    )
    counted = spans.groupBy("kind", "votes").count().collect()
    posterior = reliabilities([(r["kind"], tuple(r["votes"]), r["count"]) for r in counted])
    yes_all, no_all = dict.fromkeys(KINDS, 0.0), dict.fromkeys(KINDS, 0.0)
    for r in counted:
        p = posterior[r["kind"], tuple(r["votes"])]
        yes_all[r["kind"]] += p * r["count"]
        no_all[r["kind"]] += (1 - p) * r["count"]
    yes: dict[tuple[str, str], float] = {}
    no: dict[tuple[str, str], float] = {}
    per_feature = spans.select("kind", "votes", F.explode("features").alias("feature"))
    for r in per_feature.groupBy("kind", "votes", "feature").count().collect():
        key, p = (r["kind"], r["feature"]), posterior[r["kind"], tuple(r["votes"])]
        yes[key] = yes.get(key, 0.0) + p * r["count"]
        no[key] = no.get(key, 0.0) + (1 - p) * r["count"]
    weights = {key: _log_odds(yes[key], no[key], yes_all[key[0]], no_all[key[0]]) for key in yes}
    return weights | {(k, ""): math.log((yes_all[k] + 1) / (no_all[k] + 1)) for k in KINDS}


def _probability(candidate: Column, weights: dict[tuple[str, str], float]) -> Column:
    pairs = [F.lit(x) for (kind, feature), w in sorted(weights.items()) for x in (f"{kind} {feature}", w)]
    table_ = F.create_map(*pairs)

    def weight(feature: Column) -> Column:
        return F.coalesce(F.element_at(table_, F.concat(candidate["kind"], F.lit(" "), feature)), F.lit(0.0))

    score = F.aggregate(candidate["features"], weight(F.lit("")), lambda a, f: a + weight(f))
    return 1 / (1 + F.exp(-score))


def _is_base(c: Column) -> Column:
    return ~c["loose"] & (F.element_at(c["votes"], 1) == 1)


def of_kind(spans: Column, kind: str) -> Column:
    return F.filter(spans, lambda c: c["kind"] == kind)


def decided(candidates: DataFrame, weights: dict[tuple[str, str], float], add_from: float = ADD_FROM) -> DataFrame:
    """Adds ``base`` and ``spans``: arrays of (kind, start, end), by kind as listed, then start."""

    def narrow(spans: Column) -> Column:
        return F.transform(spans, lambda c: F.struct(*(c[n].alias(n) for n in ("kind", "start", "end"))))

    def added(c: Column) -> Column:
        """A loose candidate the classifier believes, clear of the base spans of its kind."""

        def clash(b: Column) -> Column:
            return (b["kind"] == c["kind"]) & (b["start"] < c["end"]) & (c["start"] < b["end"])

        return c["loose"] & (_probability(c, weights) >= add_from) & ~F.exists("base", clash)

    def in_order(spans: Column) -> Column:
        return F.concat(*(F.array_sort(of_kind(spans, kind)) for kind in KINDS))

    based = candidates.withColumn("base", in_order(narrow(F.filter("candidates", _is_base))))
    return based.withColumn("spans", in_order(F.concat("base", narrow(F.filter("candidates", added)))))


def joined(spans: Column) -> Column:
    parts = F.transform(spans, lambda c: F.concat_ws(":", c["kind"], c["start"].cast("string"), c["end"].cast("string")))
    return F.array_join(parts, ",")


def stored_candidates(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Candidates written once to the shared folder: training and decision read them, not the texts."""
    spark = docs.sparkSession
    path = scratch_path(spark, "spans")
    candidate_table(docs, keep).write.parquet(path)
    return spark.read.parquet(path)


def private_spans(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id``, ``base`` and ``spans`` per row."""
    narrow = docs.select(F.col(id_column).cast("long").alias("doc_id"), whole_text(text_column).alias("text"))
    candidates = stored_candidates(narrow, ["doc_id"])
    return decided(candidates, train(candidates)).drop("candidates")


def _redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind; spans that overlap become one gap."""

    def step(state: Column, span: Column) -> Column:
        start, end, at = span["start"], span["end"], state["at"]
        fresh = F.concat(
            state["out"], F.substring(text, at + 1, start - at), F.lit("["), F.upper(span["kind"]), F.lit("]")
        )
        return F.struct(F.greatest(at, end).alias("at"), F.when(start >= at, fresh).otherwise(state["out"]).alias("out"))

    in_order = F.array_sort(F.transform(spans, lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"), c["kind"].alias("kind"))))
    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    done = F.aggregate(in_order, first, step, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))
    return F.when(F.size(spans) == 0, text).otherwise(done)


def redacted(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, with every private span of ``text`` replaced; ``n_chars`` follows the text.

    A null text stays null.
    """
    # The document travels as one struct, so no column name can clash.
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("document"), whole_text())
    candidates = stored_candidates(whole, ["document"])
    found = decided(candidates, train(candidates))
    clean = found.select("document", _redacted(F.col("document.text"), F.col("spans")).alias("clean"))
    columns = {"text": F.col("clean"), "n_chars": F.coalesce(F.length("clean").cast("long"), F.lit(0).cast("long"))}
    return clean.select(*(columns.get(c, F.col("document").getField(c)).alias(c) for c in docs.columns))


def op8_private_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = private_spans(table(spark, sf_dir, "documents"))

    def number(kind: str) -> Column:
        return F.size(of_kind(F.col("base"), kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *(number(kind) for kind in KINDS),
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
    )
