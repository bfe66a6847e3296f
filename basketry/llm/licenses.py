"""Licences named or quoted in documents, by ordered signature rules.

A text becomes its lower-cased words (A-Z only), one blank between them. Rules are regular expressions
over that form, in order: quoted licence texts first, then tags, notices, addresses, names, and bare
mentions. A rule runs only on texts that have all its keywords as words. Each place where a rule matches
is an interval of words. A place within the interval of a higher class, or within a longer one (of
equal ones, an earlier rule's) of its own class, is suppressed: `general public license` inside
`gnu lesser general public license` is no mention of its own. What partly overlaps stays.

All of it is DataFrame expressions on single rows: there is no exchange, and no two rows meet.

The base signatures are fixed phrases. Their labels stay whatever the rules say.

Null text counts as empty, without words or places. Every input row gives one row: null ids, rows with
the same id and repeated rows alike. An empty table gives an empty result. Other columns are ignored.
Texts are taken whole, whatever their length.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The signatures of the base.
BASE = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

# label, keywords (the first is looked for first), its name as a pattern over words.
LICENSES = (
    ("0bsd", "0bsd", "0bsd"),
    ("0bsd", "bsd zero clause", "bsd zero clause(?: license)?"),
    ("afl-3.0", "academic free", "academic free license(?: v(?:ersion)?)?(?: 3(?: 0)?)?"),
    ("agpl-3.0", "affero", "(?:gnu )?affero (?:gpl|general public license)(?: (?:v|version )?3)?"),
    ("agpl-3.0", "agpl", "(?:gnu )?agpl(?:v3| v3| 3)?"),
    ("apache-1.1", "apache 1", "apache(?: software)? license(?: v| version)? 1 1"),
    ("apache-2.0", "apache 2", "apache(?: software)? licen[cs]e(?: v| version)? 2(?: 0)?"),
    ("apache-2.0", "apache v2", "apache(?: software)? licen[cs]e v2(?: 0)?"),
    ("apsl-2.0", "apple source", "apple public source license(?: version)?(?: 2(?: 0)?)?"),
    ("artistic-2.0", "artistic 2", "artistic license(?: v| version)? 2(?: 0)?"),
    ("artistic-1.0", "artistic", "(?:clarified )?artistic license(?: 1 0)?"),
    ("beerware", "beerware", "beerware(?: license)?"),
    ("blueoak-1.0.0", "blue oak", "blue oak model license(?: 1 0 0)?"),
    ("bsd-2-clause", "bsd 2", "bsd(?: license)? 2 clause(?: license)?"),
    ("bsd-2-clause", "simplified bsd", "simplified bsd license"),
    ("bsd-2-clause", "freebsd", "freebsd license"),
    ("bsd-3-clause", "bsd 3", "bsd(?: license)? 3 clause(?: license)?"),
    ("bsd-3-clause", "bsd license", "(?:revised|modified) bsd license"),
    ("bsd-3-clause", "bsd new", "new bsd license"),
    ("bsd-4-clause", "bsd 4", "bsd 4 clause(?: license)?"),
    ("bsl-1.0", "boost", "boost software license(?: version)?(?: 1 0)?"),
    ("busl-1.1", "business source", "business source license(?: 1 1)?"),
    ("cc0-1.0", "cc0", "(?:creative commons )?cc0(?: 1 0)?(?: universal)?"),
    ("cc-by-4.0", "creative commons attribution", "creative commons attribution(?: 4 0)?(?: international)?"),
    ("cc-by-4.0", "cc by", "cc by(?: [1-4] 0)?"),
    ("cc-by-nc-4.0", "cc by nc", "cc by nc(?: [1-4] 0)?"),
    ("cc-by-nc-4.0", "noncommercial", "creative commons attribution noncommercial(?: [1-4] 0)?"),
    ("cc-by-sa-4.0", "cc by sa", "cc by sa(?: [1-4] 0)?"),
    ("cc-by-sa-4.0", "sharealike", "creative commons attribution sharealike(?: [1-4] 0)?"),
    ("cc-by-nd-4.0", "cc by nd", "cc by nd(?: [1-4] 0)?"),
    ("cddl-1.0", "cddl", "cddl(?: (?:v|version )?1(?: [01])?)?"),
    ("cddl-1.0", "development distribution", "common development and distribution license(?: 1 [01])?"),
    ("cecill-2.1", "cecill", "cecill(?: (?:[abc]|2 [01]))?(?: license)?"),
    ("cpal-1.0", "attribution common", "common public attribution license(?: version)?(?: 1 0)?"),
    ("cpl-1.0", "public common", "common public license(?: version)?(?: 1 0)?"),
    ("ecl-2.0", "educational", "educational community license(?: version)?(?: 2 0)?"),
    ("elastic-2.0", "elastic", "elastic license(?: 2 0| v2)?"),
    ("epl-1.0", "eclipse 1", "eclipse public license(?: v| version)? 1(?: 0)?"),
    ("epl-2.0", "eclipse 2", "eclipse public license(?: v| version)? 2(?: 0)?"),
    ("epl-2.0", "eclipse", "eclipse public license"),
    ("eupl-1.2", "eupl", "eupl(?: v?1 [012])?"),
    ("eupl-1.2", "european union public", "european union public licen[cs]e(?: v? ?1 [012])?"),
    ("gfdl-1.3", "documentation free", "(?:gnu )?free documentation license(?: version)?(?: 1 [123])?"),
    ("gpl-2.0", "general public 2", "(?:gnu )?general public license(?: v| version)? 2(?: 0)?"),
    ("gpl-2.0", "gplv2", "(?:gnu )?gplv2"),
    ("gpl-2.0", "gpl 2", "(?:gnu )?gpl(?: v| version)? 2(?: 0)?"),
    ("gpl-3.0", "general public 3", "(?:gnu )?general public license(?: v| version)? 3(?: 0)?"),
    ("gpl-3.0", "gplv3", "(?:gnu )?gplv3"),
    ("gpl-3.0", "gpl 3", "(?:gnu )?gpl(?: v| version)? 3(?: 0)?"),
    ("hpnd", "historical permission", "historical permission notice and disclaimer"),
    ("ipl-1.0", "ibm public", "ibm public license(?: version)?(?: 1 0)?"),
    ("isc", "isc license", "isc license"),
    ("lgpl-2.1", "lesser 2", "(?:gnu )?(?:lesser|library) general public license(?: v| version)? 2(?: [01])?"),
    ("lgpl-3.0", "lesser 3", "(?:gnu )?lesser general public license(?: v| version)? 3(?: 0)?"),
    ("lgpl", "lesser", "(?:gnu )?lesser general public license"),
    ("lgpl", "lgpl", "(?:gnu )?lgpl(?: ?v?[23](?: [01])?)?"),
    ("lgpl-2.1", "lgplv2", "(?:gnu )?lgplv2(?: 1)?"),
    ("lgpl-3.0", "lgplv3", "(?:gnu )?lgplv3"),
    ("lppl-1.3c", "latex project", "latex project public license(?: version)?(?: 1 3c?)?"),
    ("mit-0", "attribution mit no", "mit no attribution(?: license)?"),
    ("mit", "expat", "expat license"),
    ("mit", "x11", "x11 license"),
    ("mit", "license mit", "mit license"),
    ("mit", "licence mit", "mit licence"),
    ("mpl-1.1", "mozilla 1", "mozilla public license(?: v| version)? 1(?: [01])?"),
    ("mpl-2.0", "mozilla 2", "mozilla public license(?: v| version)? 2(?: 0)?"),
    ("mpl-2.0", "mozilla", "mozilla public license"),
    ("ms-pl", "microsoft public", "microsoft public license"),
    ("ms-rl", "microsoft reciprocal", "microsoft reciprocal license"),
    ("mulan-2.0", "mulan", "mulan (?:permissive software|psl)(?: license)?(?: v2| version 2)?"),
    ("ncsa", "ncsa illinois", "university of illinois(?: [^ ]+){0,4} ncsa open source license"),
    ("odbl-1.0", "database open", "open (?:data commons )?(?:open )?database license(?: v?1 0)?"),
    ("ofl-1.1", "sil font open", "sil open font license(?: version)?(?: 1 1)?"),
    ("openssl", "openssl", "openssl license"),
    ("osl-3.0", "software open", "open software license(?: v| version)?(?: 3 0)?"),
    ("php-3.01", "php", "php license(?: version)?(?: 3 0?1?)?"),
    ("postgresql", "postgresql", "postgresql licen[cs]e"),
    ("psf-2.0", "python", "python software foundation license(?: version)?(?: 2)?"),
    ("qpl-1.0", "q", "q public license(?: version)?(?: 1 0)?"),
    ("rail", "rail", "(?:creativeml )?(?:open )?rail(?: m)?(?: license)?"),
    ("sspl-1.0", "server side", "server side public license(?: v?1)?"),
    ("unlicense", "unlicense", "(?:the )?unlicense"),
    ("upl-1.0", "universal permissive", "universal permissive license(?: v| version)?(?: 1 0)?"),
    ("vim", "vim", "vim license"),
    ("w3c", "w3c", "w3c(?: software)?(?: notice and)? license"),
    ("wtfpl", "wtfpl", "wtfpl"),
    ("zlib", "zlib", "zlib(?: libpng)? license"),
    ("zpl-2.1", "zope", "zope public license(?: version)?(?: 2 [01])?"),
)

# Sentences that only the licence itself has: label, keywords, pattern.
TEXTS = (
    ("mit", "hereby obtaining", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit", "sublicense merge", "use copy modify merge publish distribute sublicense and or sell copies"),
    ("mit", "portions substantial", "shall be included in all copies or substantial portions of the software"),
    ("isc", "permission hereby", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("apache-2.0", "compliance except", "you may not use this file except in compliance with the license"),
    ("apache-2.0", "contributor perpetual", "each contributor hereby grants to you a perpetual worldwide non exclusive"),
    ("apache-2.0", "basis conditions", "distributed on an as is basis without warranties or conditions of any kind"),
    ("bsd", "redistribution binary", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", "redistributions retain", "redistributions of source code must retain the above copyright notice"),
    ("bsd", "redistributions reproduce", "redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-3-clause", "endorse neither", "neither the names? of (?:[^ ]+ ){1,12}may be used to endorse or promote products"),
    ("bsd-4-clause", "advertising acknowledgement", "all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("gpl", "gnu redistribute", "you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "redistribute lesser", "you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license"),
    ("agpl-3.0", "redistribute affero", "you can redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("gpl", "copyleft free", "the gnu general public license is a free copyleft license"),
    ("gpl", "verbatim everyone", "everyone is permitted to copy and distribute verbatim copies of this license document"),
    ("gpl", "merchantability hope", "in the hope that it will be useful but without any warranty without even the implied warranty of merchantability"),
    ("mpl-2.0", "mozilla subject", "this source code form is subject to the terms of the mozilla public license"),
    ("epl-2.0", "eclipse terms", "made available under the terms of the eclipse public license"),
    ("bsl-1.0", "boost hereby", "boost software license version 1 0 permission is hereby granted"),
    ("zlib", "express altered", "altered source versions must be plainly marked as such"),
    ("unlicense", "unencumbered domain", "free and unencumbered software released into the public domain"),
    ("cc0-1.0", "waiving dedicated", "has dedicated the work to the public domain by waiving all"),
    ("cc0-1.0", "affirmer waives", "affirmer hereby overtly fully permanently irrevocably and unconditionally waives"),
    ("wtfpl", "fuck", "do what the fuck you want to public license"),
    ("ofl-1.1", "font reserved", "no modified version of the font software may use the reserved font name"),
    ("proprietary", "reserved rights", "all rights reserved"),
    ("proprietary", "proprietary confidential", "proprietary and confidential"),
    ("proprietary", "prohibited strictly", "unauthorized copying of this file via any medium is strictly prohibited"),
    ("public-domain", "placed domain", "placed in(?:to)? the public domain"),
    ("public-domain", "dedicated domain", "dedicated to the public domain"),
)

# Families without a version: label, keywords, pattern.
MENTIONS = (
    ("apache", "apache license", "apache license"),
    ("bsd", "bsd license", "bsd(?: style)? license"),
    ("gpl", "general public", "(?:gnu )?general public license"),
    ("gpl", "gpl", "gnu gpl|gpl licensed"),
    ("creative-commons", "creative commons", "creative commons"),
    ("mit", "mit style", "mit style license"),
    ("public-domain", "public domain", "public domain"),
)

# Addresses where licences stand, as words: label, keywords, pattern.
ADDRESSES = (
    ("apache-2.0", "apache org", "(?:www )?apache org licenses license 2 0(?: (?:txt|html))?"),
    ("gpl", "gnu org", "(?:www )?gnu org (?:licenses|copyleft)(?: gpl)?(?: [23] 0)?(?: (?:txt|html))?"),
    ("lgpl", "gnu org lgpl", "(?:www )?gnu org (?:licenses|copyleft) lgpl(?: [23] [01])?"),
    ("mpl-2.0", "mozilla org", "(?:www )?mozilla org mpl(?: 2 0)?"),
    ("cc0-1.0", "creativecommons zero", "creativecommons org publicdomain zero 1 0"),
    ("creative-commons", "creativecommons", "creativecommons org licenses by(?: (?:nc|nd|sa))*(?: [1-4] 0)?"),
    ("bsl-1.0", "boost org", "(?:www )?boost org license 1 0(?: txt)?"),
    ("unlicense", "unlicense org", "unlicense org"),
    ("wtfpl", "wtfpl net", "(?:www )?wtfpl net"),
)

# Class of a rule, from the strongest evidence to the weakest, and its strength.
TEXT, TAG, NOTICE, ADDRESS, NAME, MENTION = range(6)
STRENGTHS = (1.0, 0.95, 0.9, 0.8, 0.7, 0.5)

UNDER = (
    "(?:licensed|released|distributed|available|published|provided|covered|governed) "
    "(?:[^ ]+ ){0,2}(?:under|by) (?:[^ ]+ ){0,6}?"
)


def _tagged(label: str) -> tuple[str, str]:
    """Keywords and pattern of the identifier after its tag."""
    words = re.split(r"[^0-9a-z]+", label)
    return "spdx identifier " + " ".join(words), "spdx license identifier " + " ".join(words) + (
        "(?: (?:only|or later))?"
    )


def rules() -> list[dict]:
    """The rules in order: class, label, keywords that a text must have, pattern over its words."""
    labels = sorted({label for label, _, _ in LICENSES})
    found = [(TEXT, *rule) for rule in TEXTS]
    found += [(TAG, label, *_tagged(label)) for label in labels]
    for kind, prefix in ((NOTICE, UNDER), (NAME, "")):
        found += [
            (kind, label, words, f"{prefix}(?:{name})") for label, words, name in LICENSES
        ]
    found += [(ADDRESS, *rule) for rule in ADDRESSES]
    found += [(MENTION, *rule) for rule in MENTIONS]
    return [
        {
            "class": kind,
            "rule": number,
            "label": label,
            "key": words.split()[0],
            "words": words.split(),
            "pattern": f"(?<![^ ])(?:{pattern})(?![^ ])",
        }
        for number, (kind, label, words, pattern) in enumerate(sorted(found, key=lambda r: r[0]))
    ]


RULE_TYPE = "struct<class:int,rule:int,label:string,words:array<string>,pattern:string>"
BASE_PATTERN = f"(?<![^ ])(?:{'|'.join(BASE)})(?![^ ])"


def bound(value: Column, use) -> Column:
    """use(value) with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running(values: Column, combine) -> Column:
    """Each element combined with all before it, in as many rounds as the length has binary digits."""

    def over(items: Column) -> Column:
        steps = F.transform(
            F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(F.size(items), F.lit(1)))).cast("int")),
            lambda k: F.call_function("shiftleft", F.lit(1), k),
        )
        return F.aggregate(
            steps,
            items,
            lambda so_far, step: F.transform(
                so_far,
                lambda x, i: F.when(i >= step, combine(F.get(so_far, i - step), x)).otherwise(x),
            ),
        )

    return bound(values, over)


def _blanks(text: Column) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))).cast("long")


def places(text: Column, pattern: Column) -> Column:
    """First and last word of each place where the pattern matches a text of single blanks."""

    def of(both: Column) -> Column:
        pieces, matches = both["pieces"], both["matches"]
        gaps = F.transform(
            matches,
            lambda match, i: _blanks(F.get(pieces, i))
            + F.when(i > 0, _blanks(F.get(matches, i - 1))).otherwise(F.lit(0)),
        )
        return F.zip_with(
            running(gaps, lambda a, b: a + b),
            matches,
            lambda first, match: F.struct(
                first.alias("first"), (first + _blanks(match)).alias("last"), match.alias("found")
            ),
        )

    split = F.struct(
        F.split(text, pattern, -1).alias("pieces"),
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("matches"),
    )
    return bound(split, of)


def by_key(known: list[dict]) -> Column:
    """The rules under the first of their keywords, as a constant map."""
    table: dict[str, list[dict]] = {}
    for rule in known:
        table.setdefault(rule["key"], []).append(rule)
    return F.from_json(F.lit(json.dumps(table)), f"map<string,array<{RULE_TYPE}>>")


def detected(text: Column, words: Column, table: Column) -> Column:
    """Every place of every rule whose keywords are among the words, in order of the first word."""

    def of(rule: Column) -> Column:
        return F.transform(
            places(text, rule["pattern"]),
            lambda place: F.struct(
                place["first"].alias("first"),
                (-place["last"]).alias("minus_last"),
                rule["class"].alias("class"),
                rule["rule"].alias("rule"),
                rule["label"].alias("label"),
            ),
        )

    lists = F.transform(words, lambda word: F.try_element_at(table, word))
    gated = F.filter(
        F.flatten(F.filter(lists, lambda some: some.isNotNull())),
        lambda rule: F.forall(rule["words"], lambda word: F.array_contains(words, word))
        & F.rlike(text, rule["pattern"]),
    )
    return F.array_sort(F.flatten(F.transform(gated, of)))


def unsuppressed(found: Column) -> Column:
    """The places that lie in no interval of a higher class or a longer one of their own."""
    classes = F.array(*[F.lit(k) for k in range(len(STRENGTHS))])

    def of(items: Column) -> Column:
        reach = F.transform(
            items,
            lambda item: F.transform(
                classes,
                lambda k: F.when(item["class"] <= k, -item["minus_last"]).otherwise(F.lit(-1)),
            ),
        )
        longest = running(reach, lambda a, b: F.zip_with(a, b, lambda x, y: F.greatest(x, y)))
        return bound(
            longest,
            lambda upto: F.filter(
                items,
                lambda item, i: (i == 0)
                | (F.get(F.get(upto, i - 1), item["class"]) < -item["minus_last"]),
            ),
        )

    kept = bound(found, of)
    return F.transform(
        kept,
        lambda item: F.struct(
            item["label"].alias("label"),
            item["rule"].alias("rule"),
            item["class"].alias("class"),
            item["first"].alias("first_word"),
            (-item["minus_last"]).alias("last_word"),
        ),
    )


def scanned(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, detections, labels, score).

    detections: label, rule, class and interval of words of each place that is not suppressed.
    labels: those of the base and of the detections. score: the strength of the strongest evidence.
    """
    known = rules()
    table = by_key(known)
    first = F.array(*[F.lit(w) for w in sorted({rule["key"] for rule in known})])
    keywords = F.array(*[F.lit(w) for w in sorted({w for rule in known for w in rule["words"]})])
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    separators = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    spaced = docs.select(
        "doc_id",
        F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), separators, " ")).alias("words"),
    )
    gated = spaced.select(
        "doc_id",
        F.when(F.col("words") == "", F.lit(0)).otherwise(_blanks(F.col("words")) + 1).alias("n_words"),
        "words",
        # `lower` also changes letters beyond A-Z, which at most lets more texts through the gate.
        F.array_intersect(F.split(F.lower("words"), " "), keywords).alias("keywords"),
    )
    gated = gated.select(
        "doc_id",
        "n_words",
        "keywords",
        F.when(
            F.arrays_overlap("keywords", first), F.translate("words", capitals, capitals.lower())
        ).alias("words"),
    )
    none = F.array().cast("array<struct<first:bigint,last:bigint,found:string>>")
    with_base = F.array_contains("keywords", "license")
    found = gated.select(
        "doc_id",
        "n_words",
        F.when(with_base, places(F.col("words"), F.lit(BASE_PATTERN))).otherwise(none).alias("base"),
        F.when(
            F.col("words").isNotNull(),
            unsuppressed(detected(F.col("words"), F.col("keywords"), table)),
        ).alias("some"),
    )
    empty = "array<struct<label:string,rule:int,class:int,first_word:bigint,last_word:bigint>>"
    by_phrase = F.create_map(*[F.lit(x) for pair in BASE.items() for x in pair])
    placed = found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.get("base", F.lit(0))["first"].alias("first_word"),
        F.try_element_at("base", F.lit(-1))["first"].alias("last_word"),
        F.array_sort(
            F.array_distinct(F.transform("base", lambda b: F.element_at(by_phrase, b["found"])))
        ).alias("base_list"),
        F.coalesce("some", F.array().cast(empty)).alias("detections"),
    )
    strengths = F.array(*[F.lit(s) for s in STRENGTHS])
    strongest = F.array_max(F.transform("detections", lambda d: F.get(strengths, d["class"])))
    names = F.array_union("base_list", F.transform("detections", lambda d: d["label"]))
    weakest = F.when(F.col("n_base") > 0, STRENGTHS[MENTION]).otherwise(0.0)
    return placed.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base_list", ",").alias("base_labels"),
        "detections",
        F.array_join(F.array_sort(names), ",").alias("labels"),
        F.greatest(F.coalesce(strongest, F.lit(0.0)), weakest).alias("score"),
    )
