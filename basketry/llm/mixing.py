"""Mixing documents so that the tokens of each domain come to given weights.

Domains are soft: a classifier learned from the labels gives each document a probability for each
domain. It is a naive Bayes classifier of two kinds of facts. One is the words: for the distinct words
of the labelled documents the documents of each domain are counted, and of those whose counts differ
more than chance explains (at most VOCABULARY, the most telling first) the log-likelihood ratios for
each domain are kept. A document's evidence for a domain is the sum over its own words of the ratios
above zero. Words go together, so the sum is not taken at its face: it is put into one of BINS bins,
and how often each domain's examples fall into a bin is learned. The other kind are a few rates of the
text with normal densities; means, and the variances that all domains share, come from one aggregate
over the labelled documents. A document's tokens (its words) belong to the domains by these
probabilities.

Each document gets a rate, zero or more: how often it is expected in the mixture. The rates are found by
least squares: the expected tokens of each domain are to come to its target. From rate one for all,
projected gradient steps go down along all equations, which are made orthogonal and of length one
first, and end when the projected gradient vanishes. Where no rate comes to zero these are the rates
nearest to one that give the targets.

All of it is DataFrame expressions; what comes to the driver has the size of the number of domains.

Null or empty text has no tokens and keeps rate one. Documents without a label, and labels without a
document, are no examples; null labels count as 0. A domain without examples gets no documents and
its target goes to the others. Without any example all documents keep rate one. Rows with the same
id are documents of their own; they share the labels of their id. An empty table gives an empty
result.
"""

from __future__ import annotations

import math
from collections.abc import Collection
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.scratch import stored

DOMAINS = ("plain", "good", "toxic")
# Weights of the domains in the mixture.
TARGETS = {"plain": 0.05, "good": 0.9, "toxic": 0.05}
CLOSE = 1e-5  # of a rate, in the quadratic mean over the documents
WRITTEN = 5  # steps between two writes of the rates
LEAST_VARIANCE = 1e-6
# Words that tell domains apart: how unlikely by chance (twice the log-likelihood ratio), how many.
TELLING = 20.0
VOCABULARY = 1 << 16
BINS = 6


def features(text: Column) -> dict[str, Column]:
    """Rates of a text that tell domains apart, each between 0 and about 10."""
    size = F.length(text) + 1
    words = F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit(""))) + 1
    lines = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1

    def share(pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern)) / size

    return {
        "size": F.log(size),
        "word_size": F.log(size / words),
        "line_words": F.log(words / lines),
        "symbols": share("[#*$%&|<>!]") * 10,
        "capitals": share("[A-Z]") * 10,
        "digits": share("[0-9]") * 10,
    }


def domain(quality: Column, toxic: Column) -> Column:
    """The domain of a labelled document."""
    return (
        F.when(F.coalesce(toxic, F.lit(0)) > 0, "toxic")
        .when(F.coalesce(quality, F.lit(0)) > 0, "good")
        .otherwise("plain")
    )


def word_count(text: Column) -> Column:
    """How many words a text has between white space, of which some may stand at its ends."""
    empty = [text == "", *[F.substring(text, at, 1).isin(*" \t\n\v\f\r") for at in (1, -1)]]
    return F.size(F.split(text, "[ \t-\r]+")) - sum((x.cast("int") for x in empty), F.lit(0))


def words_of(text: Column) -> Column:
    """A text's distinct words, in lower case and without punctuation marks."""
    return F.array_distinct(F.split(F.lower(text), r"""[ \t-\r.,;:!?"'()]+"""))


def row_of(text: Column) -> Column:
    """What tells texts of the same id apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, row, copies, tokens, x_<feature>): of each id and text, what is seen of it."""
    text = F.col("text")
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    facts = docs.select(
        "doc_id",
        row_of(F.col("text")).alias("row"),
        word_count(text).cast("long").alias("tokens"),
        *[x.cast("double").alias(f"x_{name}") for name, x in features(text).items()],
    )
    same = [c for c in facts.columns if c not in ("doc_id", "row")]
    return facts.groupBy("doc_id", "row").agg(
        F.count("*").alias("copies"), *[F.max(c).alias(c) for c in same]
    )


def domains_of(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of the labelled documents."""
    return labels.groupBy("doc_id").agg(domain(F.max("quality"), F.max("toxic")).alias("domain"))


def vocabulary(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """(word, for_<domain>): the ratios of the words that tell domains apart."""
    given = docs.where("text is not null").join(labelled, "doc_id")
    sizes = {one: F.sum(F.when(F.col("domain") == one, 1).otherwise(0)) for one in DOMAINS}
    examples = given.agg(*[n.alias(one) for one, n in sizes.items()]).head().asDict()
    examples = {one: float(n or 0) for one, n in examples.items()}
    total = sum(examples.values())
    counts = (
        given.select("domain", F.explode(words_of(F.col("text"))).alias("spelt"))
        .groupBy(F.xxhash64("spelt").alias("word"))
        .agg(F.count("*").alias("n"), *[n.alias(one) for one, n in sizes.items()])
    )
    n, gains, ratios = F.col("n"), [], []
    for one, size in examples.items():
        own, rest = F.col(one), total - size
        # Documents of the domain and the others, with the word and without.
        cells = [(own, n, size), (n - own, n, rest)]
        cells += [(size - own, total - n, size), (rest - n + own, total - n, rest)]
        gain = F.lit(0.0)
        for seen, of, among in cells:
            part = seen * F.log(seen * F.lit(total) / (of * F.lit(among)))
            gain = gain + F.when(seen > 0, 2 * part).otherwise(0.0)
        # Towards the share of the word in all documents by the weight of one document.
        share = n / F.lit(total)
        ratio = F.log((own + share) / F.lit(size + 1) / ((n - own + share) / F.lit(rest + 1)))
        gains.append(gain)
        ratios.append(F.when((gain >= TELLING) & (ratio > 0), ratio).otherwise(0.0).alias(f"for_{one}"))
    telling = counts.select("word", F.greatest(*gains).alias("gain"), *ratios)
    telling = telling.where(F.col("gain") >= TELLING)
    return telling.orderBy(F.desc("gain"), "word").limit(VOCABULARY).drop("gain")


def evident(facts: DataFrame, docs: DataFrame, words: DataFrame) -> DataFrame:
    """The facts with bin_<domain>: how much the document's words speak for each domain."""
    sums = (
        docs.where("text is not null")
        .select("doc_id", row_of(F.col("text")).alias("row"), F.explode(words_of(F.col("text"))).alias("spelt"))
        .withColumn("word", F.xxhash64("spelt"))
        .join(F.broadcast(words), "word")  # at most VOCABULARY rows
        .groupBy("doc_id", "row")
        .agg(*[F.sum(f"for_{one}").alias(f"for_{one}") for one in DOMAINS])
        .withColumnsRenamed({"doc_id": "of_id", "row": "of_row"})
    )
    same = F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("row") == F.col("of_row"))
    bins = []
    for one in DOMAINS:
        # Each row of an id and text adds the same words once more.
        x = F.col(f"for_{one}") / F.col("copies")
        bin_ = F.greatest(F.lit(1), F.least(F.lit(BINS - 1), F.floor(F.log2(x)) + 2))
        bins.append(F.when(x > 0, bin_).otherwise(0).cast("int").alias(f"bin_{one}"))
    return facts.join(sums, same, "left").select(*facts.columns, *bins)


def densities(facts: DataFrame, labelled: DataFrame) -> dict[str, dict[str, float]]:
    """Per domain its share of the examples, mean and variance of each feature, shares of the bins."""
    names = [c for c in facts.columns if c.startswith("x_")]
    bins = [(c, k) for c in facts.columns if c.startswith("bin_") for k in range(BINS)]
    # Each row is an example, and so are repeated ones.
    examples = facts.join(labelled, "doc_id").withColumn(
        "one", F.explode(F.sequence(F.lit(1), F.col("copies")))
    )
    moments = [F.avg(c).alias(f"mean_{c}") for c in names]
    moments += [F.var_pop(c).alias(f"var_{c}") for c in names]
    moments += [F.sum((F.col(c) == k).cast("int")).alias(f"{c}_{k}") for c, k in bins]
    found = examples.groupBy("domain").agg(F.count("*").alias("n"), *moments).collect()
    total = sum(row["n"] for row in found)
    # Domains share their variances: where their means are alike, the shares decide.
    pooled = {
        f"var_{c}": sum(row["n"] * row[f"var_{c}"] for row in found) / total for c in names if total
    }
    model = {}
    for row in found:
        shares = {}
        for c, k in bins:
            usual = (sum(other[f"{c}_{k}"] for other in found) + 1) / (total + BINS)
            shares[f"{c}_{k}"] = (row[f"{c}_{k}"] + usual) / (row["n"] + 1)
        model[row["domain"]] = {**row.asDict(), **pooled, **shares, "share": row["n"] / total}
    return model


def posteriors(names: list[str], bins: list[str], model: dict[str, dict[str, float]]) -> dict[str, Column]:
    """The probability of each domain, as an expression of the features."""
    scores = {}
    for one, known in model.items():
        score = F.lit(math.log(known["share"]))
        for c in names:
            variance = max(known[f"var_{c}"], LEAST_VARIANCE)
            apart = F.col(c) - F.lit(known[f"mean_{c}"])
            score = score - apart * apart / (2 * variance)
        for c in bins:
            logs = F.array(*[F.lit(math.log(known[f"{c}_{k}"])) for k in range(BINS)])
            score = score + F.get(logs, F.col(c))
        scores[one] = score
    highest = F.greatest(*scores.values()) if len(scores) > 1 else next(iter(scores.values()))
    weights = {one: F.exp(score - highest) for one, score in scores.items()}
    total = sum(weights.values(), F.lit(0.0))
    return {one: weight / total for one, weight in weights.items()}


class Fit(NamedTuple):
    """given: the table with its column `rate`; steps and move: how the descent ended."""

    given: DataFrame
    steps: int
    move: float


def whitened(owned: list[Column], gram: np.ndarray) -> tuple[np.ndarray, list[Column]]:
    """A matrix that makes the domains' equations orthogonal and of length one, and them after it.

    Their squares then add up to one at most along any direction, which bounds the step.
    """
    values, vectors = np.linalg.eigh(gram)
    inverse = [1 / math.sqrt(v) if v > 1e-12 * values[-1] else 0.0 for v in values]
    matrix = vectors @ np.diag(inverse) @ vectors.T
    mixed_ = [
        sum((F.lit(float(w)) * a for w, a in zip(row, owned)), F.lit(0.0)) for row in matrix
    ]
    return matrix, mixed_


def least_squares(given: DataFrame, owned: list[Column], gram: np.ndarray, wanted: np.ndarray) -> Fit:
    """Rates not below zero whose totals come nearest to `wanted`, by projected gradient steps from one.

    given: rows with `copies`, how many documents each stands for. A step goes down from a point ahead
    of the rates, in the direction of the last move, as long as the distance shrinks. It needs one
    aggregate over the table, a few numbers. The descent ends when a step moves the rates by less than
    CLOSE in the quadratic mean, which is the length of the projected gradient. The rates are written
    every few steps, so that the plan stays short and a lost executor costs few steps.
    """
    matrix, equations = whitened(owned, gram)
    target = matrix @ wanted
    given = given.withColumn("rate", F.lit(1.0)).withColumn("ahead", F.lit(1.0))
    copies, rate, ahead = F.col("copies"), F.col("rate"), F.col("ahead")
    sums = [F.sum(copies * ahead * a) for a in equations]
    row = given.agg(F.sum(copies), *sums).head()
    documents, slope = row[0], np.array(row[1:], float) - target
    steps = since = 0
    while True:
        down = sum((F.lit(float(g)) * a for g, a in zip(slope, equations)), F.lit(0.0))
        onward = since / (since + 3)
        given = (
            given.withColumns({"from": ahead, "before": rate})
            .withColumn("rate", F.greatest(F.lit(0.0), F.col("from") - down))
            .withColumn("ahead", rate + F.lit(onward) * (rate - F.col("before")))
        )
        moved = F.sum(copies * (rate - F.col("from")) * (rate - F.col("from")))
        steps += 1
        if steps % WRITTEN == 0:
            given = stored(given.drop("before"), "rates")
        row = given.agg(moved, *sums).head()
        move = math.sqrt(row[0] / documents)
        if move <= CLOSE:
            return Fit(given.drop("from", "before", "ahead"), steps, move)
        there = np.array(row[1:], float) - target
        since = since + 1 if there @ there < slope @ slope else 0
        slope = there


def classified(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, list[str]]:
    """(doc_id, row, copies, tokens, p_<domain>) of each id and text, and the domains with examples."""
    labelled = stored(domains_of(labels.select("doc_id", "quality", "toxic")), "domains")
    facts = stored(measured(docs), "features")
    words = stored(vocabulary(docs, labelled), "words")
    facts = stored(evident(facts, docs, words), "evidence")
    names = [c for c in facts.columns if c.startswith("x_")]
    bins = [c for c in facts.columns if c.startswith("bin_")]
    model = densities(facts, labelled)
    chances = posteriors(names, bins, model) if model else {}
    every = [chances.get(one, F.lit(0.0)).alias(f"p_{one}") for one in DOMAINS]
    given = stored(facts.select("doc_id", "row", "copies", "tokens", *every), "posteriors")
    return given, [one for one in DOMAINS if one in chances]


def separation(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(domain, n, likeliest, p_<domain>) of every fourth labelled document, learned from the others.

    likeliest: the share of the documents whose own domain has the highest probability.
    """
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    given, _ = classified(docs, labels.where(~held))
    highest = F.greatest(*[F.col(f"p_{one}") for one in DOMAINS])
    own = F.coalesce(*[F.when(F.col("domain") == one, F.col(f"p_{one}")) for one in DOMAINS])
    return (
        given.join(domains_of(labels.where(held)), "doc_id")
        .groupBy("domain")
        .agg(
            F.count("*").alias("n"),
            F.avg((own == highest).cast("int")).alias("likeliest"),
            *[F.avg(f"p_{one}").alias(f"p_{one}") for one in DOMAINS],
        )
    )


def fitted(
    docs: DataFrame,
    labels: DataFrame,
    targets: dict[str, float] = TARGETS,
    keep: Collection[str] = (),
) -> DataFrame:
    """What classified() gives, with the rate of each.

    The targets are weights of the domains. Together they stand for as many tokens as all documents
    have; or, if `keep` names domains, for as many that none of these has to be thinned: the most
    tokens that one of them has for its weight.
    """
    known, learned = classified(docs, labels)
    copies = F.col("copies")
    raw = {one: F.col("tokens") * F.col(f"p_{one}") for one in learned}
    upper = [(k, m) for k, one in enumerate(learned) for m in range(k, len(learned))]
    row = known.agg(
        F.sum(copies * F.col("tokens")),
        *[F.sum(copies * raw[one]) for one in learned],
        *[F.sum(copies * raw[learned[k]] * raw[learned[m]]) for k, m in upper],
    ).head()
    total, size = row[0] or 0, len(learned)
    weight = sum(targets.get(one, 0) for one in learned)
    if not learned or not total or not weight:
        return known.withColumn("rate", F.lit(1.0))
    own = dict(zip(learned, row[1 : size + 1]))
    gram = np.zeros((size, size))
    for (k, m), value in zip(upper, row[size + 1 :]):
        gram[k, m] = gram[m, k] = value
    shares = {one: targets.get(one, 0) / weight for one in learned}
    needed = [own[one] / shares[one] for one in keep if shares.get(one)]
    wanted = np.array([max(needed, default=total) * shares[one] for one in learned])
    # A domain without tokens has no equation.
    some = [k for k, one in enumerate(learned) if gram[k, k] > 0]
    owned = [raw[learned[k]] for k in some]
    return least_squares(known, owned, gram[np.ix_(some, some)], wanted[some]).given


def each_row(known: DataFrame) -> DataFrame:
    """A row for each of the copies."""
    each = F.explode(F.sequence(F.lit(1), F.col("copies")))
    return known.withColumn("copy", each).drop("copy")


def rates(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """(doc_id, tokens, p_<domain>, rate) of documents (doc_id, text)."""
    known = fitted(docs, labels, **options)
    return each_row(known).select("doc_id", "tokens", *[f"p_{one}" for one in DOMAINS], "rate")


def mixed(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents in the mixture: each as often as its rate says.

    The whole part of the rate is taken as it is; for the rest a number drawn from the id and the text
    decides, the same in every run.
    """
    known = fitted(docs, labels, **options)
    rated = known.select(F.struct("doc_id", "row").alias("key"), "rate")
    drawn = F.pmod(F.xxhash64(F.lit("mixture"), "doc.doc_id", "doc.text"), F.lit(1 << 30))
    times = F.floor(F.col("rate") + drawn / float(1 << 30)).cast("int")
    given = docs.select(F.struct(*docs.columns).alias("doc"), row_of(F.col("text")).alias("row"))
    same = F.col("doc.doc_id").eqNullSafe(F.col("key.doc_id")) & (F.col("row") == F.col("key.row"))
    return (
        given.join(rated, same)
        .withColumn("times", times)
        .where("times > 0")
        .select("doc", F.explode(F.sequence(F.lit(1), F.col("times"))))
        .select("doc.*")
    )
