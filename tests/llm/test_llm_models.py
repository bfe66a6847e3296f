"""Quality rules, languages, mixtures and transcripts."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from basketry.llm import chat, language, mixing, quality

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def table(spark):
    return lambda name: spark.read.parquet(f"{SF_DIR}/{name}.parquet")


def counted(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    covered = {
        at
        for k in range(len(words) - 4)
        if windows[tuple(words[k : k + 5])] > 1
        for at in range(k, k + 5)
    }
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return (len(words), sum(map(len, words)), symbols, again, len(covered))


def test_quality_counts(spark, table):
    odd = [
        (1000, None, None, None),
        (1001, "", "en", None),
        (1002, "a b c d e a b c d e a b c d e", None, "s"),
        (1003, "x\n x\nx\n\n \nx é　ü \x0b y", "en", "s"),
        (1004, "word " * 5000, "en", "s"),
    ]
    docs = table("documents").select("doc_id", "text", "lang", "source")
    docs = docs.union(spark.createDataFrame(odd, docs.schema)).withColumn("rate", F.lit(1))
    texts = {row["doc_id"]: row["text"] for row in docs.collect()}
    found = quality.judged(docs).collect()
    assert len(found) == len(texts)
    for row in found:
        counts = tuple(row[c] for c in quality.COUNTS)
        assert counts == counted(texts[row["doc_id"]])
        failed = counts[0] < 10 or 100 * counts[4] > 20 * counts[0]
        assert row["base_failed"] == failed
        assert not (failed and row["kept"])
    kept = {row["doc_id"] for row in found if row["kept"]}
    assert {row["doc_id"] for row in quality.kept_documents(docs).collect()} == kept
    assert quality.judged(docs.limit(0)).count() == 0


def test_quality_keeps_good_documents(table):
    judged = quality.judged(table("documents")).where("not base_failed")
    labels = table("labels")
    share = judged.join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")))
    shares = dict(share.collect())
    assert shares[1] > 0.97 and shares.get(0, 0) < 0.3


def test_sketches_merge_and_follow_the_data(spark):
    rows = [("en", f"s{k % 2}", 100, 500, k % 50, 0, 0, 10, False) for k in range(1000)]
    names = "lang string, source string, n_words long, word_chars long, n_symbols long, "
    names += "n_dup_lines long, n_repeat_words long, n_lines long, base_failed boolean"
    facts = spark.createDataFrame(rows, names)
    whole = quality.merged(quality.sketches(facts), ["lang"])
    parts = quality.merged(
        quality.sketches(facts.where("n_symbols < 20")).union(
            quality.sketches(facts.where("n_symbols >= 20"))
        ),
        ["lang"],
    )
    assert sorted(whole.collect()) == sorted(parts.collect())
    fence = quality.fences(whole, ["lang"]).head()
    # Quartiles of 0, 0.01 .. 0.49 are about 0.12 and 0.37.
    assert fence["symbols_high"] == pytest.approx(0.37 + 3 * 0.25, abs=0.04)


def test_languages(spark, table):
    docs = table("documents").select("doc_id", "text", "lang")
    odd = [(5001, None, "en"), (5002, "", "en"), (5003, "123 !? ²", None), (None, "the of", None)]
    docs = docs.union(spark.createDataFrame(odd, docs.schema)).withColumn("gram", F.lit(0))
    found = language.predicted(docs)
    assert found.count() == docs.count()
    rows = {row["doc_id"]: row for row in found.collect()}
    assert [rows[k]["lang_pred"] for k in (5001, 5002, 5003)] == ["und"] * 3
    assert rows[None]["held_out"] is False
    known = [(r["doc_id"], r["lang"]) for r in docs.where("doc_id < 5000").collect()]
    for doc, _ in known:
        assert rows[doc]["held_out"] == (zlib.crc32(str(doc).encode()) % 4 == 2)
        assert 0 <= rows[doc]["score"] <= 1
    held = [(doc, lang) for doc, lang in known if rows[doc]["held_out"]]
    assert sum(rows[doc]["lang_pred"] == lang for doc, lang in held) >= 0.9 * len(held)
    unlabelled = language.predicted(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {row["lang_pred"] for row in unlabelled.collect()} == {"und"}
    assert language.predicted(docs.limit(0)).count() == 0


def test_mixture_meets_its_targets(spark, table):
    docs = table("documents").withColumn("tokens", F.lit(0))
    targets = {"plain": 0.2, "good": 0.7, "toxic": 0.1}
    rows = mixing.rates(docs, table("labels"), targets=targets).collect()
    total = sum(row["tokens"] for row in rows)
    assert all(row["rate"] >= 0 for row in rows)

    def distance(rate):
        return sum(
            (sum(rate(row) * row["tokens"] * row[f"p_{one}"] for row in rows) / total - target) ** 2
            for one, target in targets.items()
        )

    assert distance(lambda row: row["rate"]) < 0.05 * distance(lambda row: 1)
    mixed = mixing.mixed(docs, table("labels"), targets=targets)
    assert mixed.columns == docs.columns
    copies = Counter(row["doc_id"] for row in mixed.collect())
    for row in rows:
        assert abs(copies[row["doc_id"]] - row["rate"]) < 1


def test_mixture_without_examples(spark, table):
    docs = table("documents").select("doc_id", "text")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    odd = docs.union(spark.createDataFrame([(900, None), (901, "")], docs.schema))
    assert {row["rate"] for row in mixing.rates(odd, none).collect()} == {1.0}
    assert mixing.mixed(docs.limit(0), none).count() == 0
    rates = {row["doc_id"]: row["rate"] for row in mixing.rates(odd, table("labels")).collect()}
    assert rates[900] == rates[901] == 1.0


def test_transcripts(spark, table, monkeypatch):
    # Short runs, so that transcripts go over several of them.
    monkeypatch.setattr(chat, "RUN", 3)
    turns = table("conversations").withColumn("run", F.lit(0))
    rows = chat.transcripts(turns).collect()
    roles = {(r["conv_id"], r["turn"]): r["role"] for r in turns.collect()}
    held = [row for row in rows if row["held_out"]]
    right = sum(roles[row["conv_id"], row["turn"]] == row["role_pred"] for row in held)
    assert right >= 0.9 * len(held) > 0
    # The same states as over each transcript as a whole.
    model = chat.learned(turns)
    whole = defaultdict(list)
    for row in turns.orderBy("conv_id", "turn", "text").collect():
        whole[row["conv_id"]] += [
            (row["turn"], k, p) for k, p in enumerate(chat.paragraphs(row["text"]))
        ]
    found = {(r["conv_id"], r["turn"], r["paragraph"]): (r["role_pred"], r["opens"]) for r in rows}
    for conv, items in whole.items():
        states = model.decoded(model.emitted([{"text": p} for _, _, p in items]), None, None)
        for (turn, k, _), state in zip(items, states):
            expected = (model.roles[state % len(model.roles)], state < len(model.roles))
            assert found[conv, turn, k] == expected


def test_transcripts_with_gaps(spark):
    rows = [
        (1, 0, "user", "User: hi\n\nmore of it"),
        (1, 1, "assistant", "Assistant: yes"),
        (2, None, None, None),
        (2, 0, None, ""),
        (None, 0, "user", "x"),
        (1, 1, "assistant", "Assistant: yes"),
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = chat.transcripts(turns).collect()
    assert len(found) == 7
    assert {row["rendered"].split("\n")[-2] for row in found if row["conv_id"] == 1} == {
        "hi",
        "more of it",
        "yes",
    }
    blank = chat.transcripts(turns.withColumn("role", F.lit(None).cast("string"))).collect()
    assert {row["role_pred"] for row in blank} == {None}
    assert chat.transcripts(turns.limit(0)).count() == 0
    assert chat.marked("[Human] : a") [0] == 0 or chat.marked("Human: a") == (2, "a")


def shares_of(rows, targets):
    """Expected tokens of each domain, by the rates, as shares of all tokens."""
    total = sum(row["tokens"] for row in rows)
    return {
        one: sum(row["rate"] * row["tokens"] * row[f"p_{one}"] for row in rows) / total
        for one in targets
    }


def test_mixture_meets_each_target(spark, table):
    for targets in (mixing.TARGETS, {"plain": 0.1, "good": 0.85, "toxic": 0.05}):
        rows = mixing.rates(table("documents"), table("labels"), targets=targets).collect()
        found = shares_of(rows, targets)
        assert all(found[one] == pytest.approx(share, rel=0.01) for one, share in targets.items())


def test_domains_are_told_by_words(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    found = {row["domain"]: row for row in mixing.separation(docs, labels).collect()}
    assert found["toxic"]["p_toxic"] > 5 * found["good"]["p_toxic"]
    assert found["toxic"]["likeliest"] > 0.5 and found["good"]["likeliest"] > 0.9


def test_each_rate_of_a_group_rejects(spark):
    rng = random.Random(6)

    def plain():
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.choice([4, 5, 6]))) for _ in range(120)]
        return [" ".join(words[k : k + 12]) for k in range(0, 120, 12)]

    rows = [(k, "\n".join(plain())) for k in range(200)]
    lines = plain()
    odd = {
        "symbols": "\n".join(line + " ###" for line in plain()),
        "dup_lines": "\n".join(["a b", "a b", "c d", "c d", *plain()]),
        # Less than the base rule's fifth of all words.
        "repeat_words": "\n".join(lines + ["x " + lines[0][:]]),
        "long": " ".join("".join(rng.choice("abcdefgh") for _ in range(11)) for _ in range(120)),
        "short": " ".join(rng.choice("abcdefgh") + rng.choice("abcdefgh") for _ in range(120)),
    }
    rows += [(1000 + k, text) for k, text in enumerate(odd.values())]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs = docs.withColumns({"lang": F.lit("en"), "source": F.lit("s")})
    found = {row["doc_id"]: row for row in quality.judged(docs).collect()}
    assert not any(found[1000 + k]["base_failed"] for k in range(len(odd)))
    assert [name for k, name in enumerate(odd) if found[1000 + k]["kept"]] == []
    assert sum(found[k]["kept"] for k in range(200)) >= 196


def nearest_rates(rows, wanted):
    """The rates nearest to one, by active sets: documents whose rate would be below zero have zero."""
    import numpy as np

    owned = np.array([[row["tokens"] * row[f"p_{one}"] for row in rows] for one in wanted])
    target = np.array(list(wanted.values()))
    free = np.ones(len(rows), bool)
    while True:
        some = owned[:, free]
        weights = np.linalg.lstsq(some @ some.T, some.sum(axis=1) - target, rcond=None)[0]
        rates = np.where(free, 1 - weights @ owned, 0.0)
        if (rates >= 0).all():
            return rates
        free &= rates > 0


def test_rates_equal_the_closed_form(table):
    targets = {"plain": 0.1, "good": 0.85, "toxic": 0.05}
    rows = mixing.rates(table("documents"), table("labels"), targets=targets).collect()
    total = sum(row["tokens"] for row in rows)
    rates = nearest_rates(rows, {one: share * total for one, share in targets.items()})
    found = [row["rate"] for row in rows]
    if min(rates) > 0:
        assert found == pytest.approx(list(rates), abs=1e-3)
    else:
        # Then several rates give the targets; those found are no further than a hundredth from one.
        far = sum((x - 1) ** 2 for x in found) / sum((x - 1) ** 2 for x in rates)
        assert far < 1.1


def test_domains_to_keep_are_not_thinned(table):
    for one in ("good", "plain"):
        rows = mixing.rates(table("documents"), table("labels"), keep=[one]).collect()
        own = sum(row["tokens"] * row[f"p_{one}"] for row in rows)
        mixed = {
            other: sum(row["rate"] * row["tokens"] * row[f"p_{other}"] for row in rows)
            for other in mixing.TARGETS
        }
        assert mixed[one] == pytest.approx(own, rel=0.01)
        for other, share in mixing.TARGETS.items():
            assert mixed[other] == pytest.approx(own * share / mixing.TARGETS[one], rel=0.01)


def test_targets_out_of_reach_come_as_near_as_they_can(spark):
    # No document is toxic beyond a half, so that a toxic share of nine tenths cannot be had.
    rows = [(k, 100, 1, 0.5, 0.0, 0.5) for k in range(20)] + [(99, 50, 3, 1.0, 0.0, 0.0)]
    names = "doc_id long, tokens long, copies long, p_good double, p_plain double, p_toxic double"
    given = spark.createDataFrame(rows, names)
    owned = [F.col("tokens") * F.col(f"p_{one}") for one in ("good", "toxic")]
    import numpy as np

    a = np.array([[r[1] * r[3] for r in rows], [r[1] * r[5] for r in rows]])
    weights = np.array([r[2] for r in rows])
    gram = (a * weights) @ a.T
    fit = mixing.least_squares(given, owned, gram, np.array([200.0, 1800.0]))
    found = {row["doc_id"]: row["rate"] for row in fit.given.collect()}
    assert min(found.values()) == found[99] == 0.0 and fit.move <= mixing.CLOSE
    # Both totals come from the same documents and are alike then.
    assert len({round(found[k], 3) for k in range(20)}) == 1


def test_repeated_rows_share_their_rate(spark, table):
    docs = table("documents").select("doc_id", "text")
    rows = mixing.rates(docs.union(docs.where("doc_id < 5")), table("labels")).collect()
    by_id = defaultdict(list)
    for row in rows:
        by_id[row["doc_id"]].append(row["rate"])
    assert all(len(by_id[k]) == 2 and len(set(by_id[k])) == 1 for k in range(5))


FOUR = "User: how do I sort a list?\nAssistant: use sorted()\nUser: thanks\nAssistant: welcome"


def transcript(turns, text):
    """(role, rendered) of the turns of one text, learned from `turns`, in which it stands unlabelled."""
    spark = turns.sparkSession
    one = spark.createDataFrame([(-5, 0, None, text)], "conv_id long, turn long, role string, text string")
    rows = chat.transcripts(turns.select("conv_id", "turn", "role", "text").union(one))
    found = rows.where("conv_id = -5").orderBy("paragraph").collect()
    assert all(row["opens"] for row in found)
    return [(row["role_pred"], row["rendered"].split("\n", 1)[1].strip()) for row in found]


def test_markers_open_turns_of_their_role(table):
    turns = table("conversations")
    assert transcript(turns, FOUR) == [
        ("user", "how do I sort a list?"),
        ("assistant", "use sorted()"),
        ("user", "thanks"),
        ("assistant", "welcome"),
    ]
    assert transcript(turns, "User: What is the capital of France?") == [
        ("user", "What is the capital of France?")
    ]
    mixed = "<|system|> Be kind.\n\nHuman: hi\n### Assistant: Hello. Note: this stays."
    assert transcript(turns, mixed) == [
        ("system", "Be kind."),
        ("user", "hi"),
        ("assistant", "Hello. Note: this stays."),
    ]
    # Also where the examples themselves have markers before their texts.
    told = turns.withColumn("text", F.concat(F.initcap("role"), F.lit(": "), "text"))
    assert [role for role, _ in transcript(told, FOUR)] == ["user", "assistant"] * 2


def test_markers_that_are_none_are_left(table):
    text = "Remark: nothing here.\nBob: neither."
    rendered = "".join(body for _, body in transcript(table("conversations"), text))
    assert rendered == text


def test_decoding_is_the_best_of_all_paths(table):
    import itertools

    import numpy as np

    model = chat.learned(table("conversations"))
    for text in (FOUR, "Hi.\n\nUser: a?\n\nb", "x\n\ny?\n\nz.\n\nBot: w"):
        emitted = model.emitted([{"text": p} for p in chat.paragraphs(text)])
        n = len(model.first)
        best = max(
            itertools.product(range(n), repeat=len(emitted)),
            key=lambda path: model.first[path[0]]
            + sum(emitted[k][s] for k, s in enumerate(path))
            + sum(model.move[a, b] for a, b in itertools.pairwise(path)),
        )
        assert np.array_equal(model.decoded(emitted, None, None), best)


def test_order_of_rows_does_not_depend_on_partitions(spark):
    rows = [(1, 1, "user", f"text {k * 7919 % 4000}.") for k in range(4000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    ordered = sorted(row[3] for row in rows)
    for partitions in (1, 9):
        dealt = chat.in_order(turns.repartition(partitions).select("conv_id", "turn", "text"))
        assert [row["text"] for row in dealt.collect()] == ordered


def test_characters_are_counted_without_replacing_the_others(spark):
    texts = ["", "a b", "A1 b#\n<|> C\u00c9\u00e9 99!! \u0663 $5%", "x" * 50, "&*" * 20]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    facts = mixing.measured(docs)
    assert "regexp_replace" not in facts._jdf.queryExecution().optimizedPlan().toString()
    found = {row["doc_id"]: row for row in facts.collect()}
    for k, text in enumerate(texts):
        for name, pattern in (("symbols", "[#*$%&|<>!]"), ("capitals", "[A-Z]"), ("digits", "[0-9]")):
            share = len(re.findall(pattern, text)) / (len(text) + 1) * 10
            assert found[k][f"x_{name}"] == pytest.approx(share)
        assert found[k]["tokens"] == len(text.split())


def test_words_are_counted_between_white_space(spark):
    rng = random.Random(8)
    texts = ["", " ", "\n\t", "a", " a", "a ", "\x0ba b\x0c", "é\u00a0b", "a\x1cb", "\r\n.\r\n"]
    texts += ["".join(rng.choices("ab \n\t\x0b\x0c\ré", k=rng.randrange(30))) for _ in range(300)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    counted = docs.select("text", mixing.word_count(F.col("text")).alias("n")).collect()
    for text, n in counted:
        assert n == len(re.findall(r"[^ \t-\r]+", text))
