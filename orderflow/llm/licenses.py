"""Licence scan of paragraphs, in DataFrame functions only.

A paragraph is a run of non-blank lines. What is weighed are its lines, each by itself, and its groups of
neighbouring lines, so that a notice wrapped over lines is found and two notices in one run stay two. A
group has any first and last line, of which the SPAN words next to the lines between them count, and
lines of fewer than SPAN words between them. Distinct words and pairs of words of a line or group are
hashed into BUCKETS buckets; a multinomial logistic regression over them gives a probability for each licence
family and for "unknown". It decides the family, also where the templates of several are found (CC BY-NC in
CC BY-NC-SA), and whether words that a template has are a notice or talk about one. It is trained on
the driver, from the templates below, talk about licences, and bounded samples of the corpus's own lines: some
without a cue, and some as they are scored, of which those that a template confirms are left out. The
temperature of the probabilities is calibrated on templates and lines kept from training. A prediction
stands only if a template of its family confirms it: the line or group must hold CONFIRM of its word pairs.
Where several overlap, the largest share, then the longest template, then the fewest lines, then the first comes first; another
one stands beside it only for another family that is confirmed without the word pairs of the first's.

CUES, derived from the templates, has so many word pairs of each of them that a text without any
cannot hold CONFIRM of it. Only such texts, lines and groups are skipped unscored, so most texts cost
one search and nothing that could stand is lost. Null and blank texts have no paragraphs; a null id and
repeated rows are handled row by row, and an empty table gives an empty one. Very long texts are weighed whole,
the groups of one line at a time. Of equal probabilities the class listed first is taken. Columns in ``keep``
pass through, and the result's name avoids theirs.
"""

from __future__ import annotations

import json
import math
import random
import re
from collections.abc import Callable, Iterable

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from orderflow.llm.common import free_name

BUCKETS = 4096
UNKNOWN = "unknown"
PAIR = 1e-6  # what a pair adds to a share; less than shares of different templates differ by
CUTOFF = 0.5
CONFIRM = 0.6
NEGATIVE_DOCS = 300
NEGATIVE_LINES = 4  # of each of these documents, at most LINE_CHARS long
LINE_CHARS = 400
CANDIDATE_LINES = 1000  # distinct lines that are scored, drawn for the unknown class
ROUNDS = 30
TEMPERATURES = (0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0)
# Identifiers such as GPL-2.0-only are several words; the tag in front of them is one.
WORD = r"spdx-license-identifier|[a-z0-9]++(?:\.[a-z0-9]++)*+"

# Notices, headings, grants and warranty sentences of licence families. Sentences are cut to
# at most 27 words, because SPAN, and with it the work on a wrapped notice, follows the longest.
TEMPLATES = {
    "mit": (
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "SPDX-License-Identifier: MIT",
        "The MIT License (MIT)",
        "MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
        "The above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the Software.",
        "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY",
    ),
    "apache": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
        "compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
        "SPDX-License-Identifier: Apache",
        "Apache License Version 2.0, January 2004",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an AS IS BASIS",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "SPDX-License-Identifier: GPL",
        "Licensed under the GNU GPL version 2.",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
        "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
        "You should have received a copy of the GNU General Public License along with this program.",
    ),
    "lgpl": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
        "SPDX-License-Identifier: LGPL",
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "Lesser General Public License as published by the Free Software Foundation",
        "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
        "You should have received a copy of the GNU Lesser General Public License along with this library.",
    ),
    "agpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "Affero General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
        "SPDX-License-Identifier: AGPL",
        "Licensed under the GNU AGPL version 3.",
        "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted",
        "Released under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "SPDX-License-Identifier: BSD",
        "BSD-2-Clause",
        "BSD-3-Clause",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED "
        "WARRANTIES ARE DISCLAIMED",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
        "SPDX-License-Identifier: MPL",
        "Mozilla Public License Version 2.0",
        "If a copy of the MPL was not distributed with this file, You can obtain one at "
        "http://mozilla.org/MPL/2.0/.",
    ),
    "epl": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public "
        "License 2.0",
        "Eclipse Public License - v 2.0",
        "SPDX-License-Identifier: EPL-2.0",
        "Licensed under the Eclipse Public License, version 1.0.",
    ),
    "eupl": (
        "Licensed under the EUPL.",
        "Licensed under the EUPL, Version 1.2 or later.",
        "European Union Public Licence v. 1.2",
        "SPDX-License-Identifier: EUPL-1.2",
        "Licensed under the European Union Public Licence.",
    ),
    "boost": (
        "Distributed under the Boost Software License, Version 1.0.",
        "Boost Software License - Version 1.0 - August 17th, 2003",
        "SPDX-License-Identifier: BSL-1.0",
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted",
        "ISC License",
        "SPDX-License-Identifier: ISC",
        "THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE",
    ),
    "zlib": (
        "This software is provided as-is, without any express or implied warranty.",
        "SPDX-License-Identifier: Zlib",
        "Permission is granted to anyone to use this software for any purpose, including commercial applications",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0.",
        "SPDX-License-Identifier: CC-BY-4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "cc-by-nd": (
        "Licensed under CC BY-ND 4.0.",
        "SPDX-License-Identifier: CC-BY-ND-4.0",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    ),
    "cc-by-nc-sa": (
        "Licensed under CC BY-NC-SA 4.0.",
        "SPDX-License-Identifier: CC-BY-NC-SA-4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International "
        "License.",
    ),
    "cc-by-nc-nd": (
        "Licensed under CC BY-NC-ND 4.0.",
        "SPDX-License-Identifier: CC-BY-NC-ND-4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International "
        "License.",
    ),
    "public-domain": (
        "This work is dedicated to the public domain under CC0 1.0.",
        "SPDX-License-Identifier: CC0-1.0",
        "This is free and unencumbered software released into the public domain.",
        "CC0 1.0 Universal",
        "SPDX-License-Identifier: Unlicense",
    ),
    "proprietary": (
        "Copyright by the owner. All rights reserved. No part may be reproduced without permission.",
        "All rights reserved.",
        "This software is confidential and proprietary and may not be copied or disclosed without written consent.",
    ),
}
# Talk about licences that grants nothing; a template may well be found in it.
TALK = (
    "my driving license expired", "the copyright debate", "without any warranty period", "permission to enter",
    "a license plate", "public domain music history", "copyright law",
    "we compared the mit license with the apache license and the gpl",
    "what does all rights reserved mean in this country",
    "the gnu general public license was written by lawyers and hackers",
    "students asked why the mit license is so short",
    "an article about the history of the isc license and its wording",
    "she explained that creative commons licenses come in several kinds",
    "this chapter discusses the mozilla public license and others",
    "is the eclipse public license compatible with the boost software license",
    "no license was granted for this photo",
    "he argued against the apache license version 2.0 in court",
    "the court read the bsd license aloud", "which of the two, cc by or cc by-sa, is freer",
)
CLASSES = (UNKNOWN, *TEMPLATES)


def words(line: str) -> list[str]:
    return re.findall(WORD, line.lower())


def grams(line: str) -> list[str]:
    """Distinct words and pairs of neighbouring words."""
    found = words(line)
    return sorted({*found, *(f"{a} {b}" for a, b in zip(found, found[1:], strict=False))})


def _wanted(template: str) -> list[str]:
    """What a paragraph must hold CONFIRM of: the template's word pairs, or its words if it has one only."""
    return [g for g in grams(template) if " " in g] or grams(template)


def _cues() -> str:
    """A pattern in lower case that finds something in every text that holds CONFIRM of some template.

    Of n pairs of which m are needed, any n - m + 1 do; the longest are taken, because they are rare.
    """
    chosen: set[str] = set()
    for template in (t for family in TEMPLATES.values() for t in family):
        pairs = sorted(_wanted(template), key=lambda g: (-len(g), g))
        needed = next(m for m in range(1, len(pairs) + 1) if m / len(pairs) >= CONFIRM)
        chosen.update(pairs[: len(pairs) - needed + 1])
    # Words start behind a character that is in no word, and only such stand between two words.
    return f"(?<![a-z0-9]){_alternatives(sorted(chosen))}"


def _alternatives(texts: list[str]) -> str:
    """A pattern for any of the texts, by common beginnings, so that few are tried at a place.

    A text that begins with another one is left out: where it stands, the other stands too.
    """
    if "" in texts:
        return ""
    parts = []
    for first in sorted({text[0] for text in texts}):
        rest = _alternatives([text[1:] for text in texts if text[0] == first])
        parts.append(("[^a-z0-9]++" if first == " " else re.escape(first)) + rest)
    return parts[0] if len(parts) == 1 else f"(?:{'|'.join(parts)})"


CUES = _cues()

# Words of a group's first and last line that count, and bound of the words between them.
SPAN = 2 * max(len(words(t)) for family in TEMPLATES.values() for t in family)


def bucket(gram: str) -> int:
    return xxhash.xxh64_intdigest(gram.encode(), 42) % BUCKETS


class Model:
    """Weights by class and bucket, biases, and the temperature."""

    def __init__(self) -> None:
        self.weights = np.zeros((len(CLASSES), BUCKETS))
        self.bias = np.zeros(len(CLASSES))
        self.temperature = 1.0

    def logits(self, features: np.ndarray) -> np.ndarray:
        return self.bias + self.weights[:, features].sum(axis=1) / math.sqrt(len(features) or 1)

    def probabilities(self, features: np.ndarray) -> np.ndarray:
        values = self.logits(features) / self.temperature
        powers = np.exp(values - values.max())
        return powers / powers.sum()

    def fit(self, examples: list[tuple[np.ndarray, int]], seed: int = 3) -> Model:
        """Stochastic gradient descent with a little decay of the weights that are met."""
        order = np.random.default_rng(seed)
        for turn in range(ROUNDS):
            rate = 2.0 / (1 + turn / 5)
            for at in order.permutation(len(examples)):
                features, label = examples[at]
                slope = self.probabilities(features)
                slope[label] -= 1
                scale = 1 / math.sqrt(len(features) or 1)
                self.bias -= 0.1 * rate * slope
                met = self.weights[:, features]
                self.weights[:, features] = met - rate * scale * (slope[:, None] + 1e-4 * met)
        return self

    def loss(self, examples: list[tuple[np.ndarray, int]], temperature: float) -> float:
        before, self.temperature = self.temperature, temperature
        total = -sum(math.log(max(1e-12, self.probabilities(f)[label])) for f, label in examples)
        self.temperature = before
        return total


def features_of(line: str) -> np.ndarray:
    return np.array(sorted({bucket(g) for g in grams(line)}), dtype=np.int64)


def share_of(line: str, family: str) -> float:
    """The largest share of the wanted word pairs of one of the family's templates."""
    found = set(grams(line))
    return max(len(found & set(_wanted(t))) / len(_wanted(t)) for t in TEMPLATES[family])


def _variants(line: str, rng: random.Random) -> Iterable[str]:
    """The line, and versions with words lost or added at the ends or dropped inside."""
    parts = line.split()
    yield line
    for _ in range(6):
        kept = [w for w in parts if rng.random() > 0.1]
        before = rng.choice(["", "note", "this document is", "(c) 2020 someone"])
        after = rng.choice(["", "see file", "for details", "thanks"])
        yield f"{before} {' '.join(kept)} {after}"


def _examples(templates: list[tuple[str, int]], others: list[str], seed: int) -> list[tuple[np.ndarray, int]]:
    rng = random.Random(seed)
    labelled = [(line, k) for template, k in templates for line in _variants(template, rng)]
    labelled += [(line, 0) for line in others]
    return [(features_of(line), k) for line, k in labelled]


def train(negatives: list[str], candidates: Iterable[str] = (), seed: int = 5) -> Model:
    """A model from the templates, lines that are no licences, and lines that only look like some.

    ``candidates`` are lines as ``scan`` scores them; those that a template confirms are left out, the
    others are examples of the unknown class. The temperature is chosen on templates, and a fifth of
    the unknown lines, that the model it is chosen with has not seen; then all are learned.
    """
    templates = [(t, k) for k, family in enumerate(CLASSES[1:], 1) for t in TEMPLATES[family]]
    doubtful = [c for c in candidates if all(share_of(c, f) < CONFIRM for f in TEMPLATES)]
    others = [*negatives, *[line for talk in TALK for line in _variants(talk, random.Random(seed))], *doubtful, ""]
    random.Random(seed).shuffle(others)
    # Every third template of a family is held out, so that each family has some left.
    held = [(t, k) for n, (t, k) in enumerate(templates) if TEMPLATES[CLASSES[k]].index(t) % 3 == 2]
    seen = [pair for pair in templates if pair not in held]
    cut = len(others) // 5
    trial = Model().fit(_examples(seen, others[cut:], seed))
    unseen = _examples(held, others[:cut], seed + 1)
    model = Model().fit(_examples(templates, others, seed))
    model.temperature = min(TEMPERATURES, key=lambda t: trial.loss(unseen, t))
    return model


def sample_negatives(docs: DataFrame, text_col: str = "text") -> list[str]:
    """A bounded number of lines without a cue, drawn by a hash of the text."""
    text = F.col(text_col).cast("string")
    lines = F.filter(
        F.split(text, "\n"),
        lambda x: (F.char_length(x) <= LINE_CHARS) & (x != "") & ~F.lower(x).rlike(CUES),
    )
    hashed = docs.where(text.isNotNull()).withColumn("_h", F.xxhash64(text))
    # First the hashes alone, so that no task sends texts that are not chosen.
    smallest = hashed.select("_h").distinct().orderBy("_h").limit(NEGATIVE_DOCS)
    chosen = [row[0] for row in smallest.collect()]
    rows = (
        hashed.where(F.col("_h").isin(chosen))
        .groupBy("_h")
        .agg(F.min(F.slice(lines, 1, NEGATIVE_LINES)).alias("lines"))
        .collect()
    )
    return [line for row in sorted(rows) for line in row.lines]


def sample_candidates(docs: DataFrame, text_col: str = "text") -> list[str]:
    """A bounded number of lines with a cue, as ``scan`` scores them, drawn by a hash of the line.

    Equal lines are one, by partial aggregation.
    """
    text = F.col(text_col).cast("string")
    lines = F.filter(
        F.split(text, "\n"), lambda x: (F.char_length(x) <= LINE_CHARS) & F.lower(x).rlike(CUES)
    )
    found = docs.where(F.lower(text).rlike(CUES)).select(F.explode(lines).alias("line")).distinct()
    return [r.line for r in found.orderBy(F.xxhash64("line"), "line").limit(CANDIDATE_LINES).collect()]


def _words_column(line: Column) -> Column:
    return F.regexp_extract_all(F.lower(line), F.lit(WORD), F.lit(0))


def _grams_column(line: Column) -> Column:
    return _grams_of(_words_column(line))


def _grams_of(found: Column) -> Column:
    # Pairs: each word with its successor; the last has none and gives null, which is dropped.
    after = F.concat(F.slice(found, 2, F.greatest(F.size(found) - 1, F.lit(0))), F.array(F.lit(None).cast("string")))
    pairs = F.zip_with(found, after, lambda a, b: F.concat(a, F.lit(" "), b))
    return F.array_distinct(F.array_compact(F.concat(found, pairs)))


def _literal(values: list, kind: str) -> Column:
    """A constant array, as one folded literal."""
    return F.from_json(F.lit(json.dumps(values)), f"array<{kind}>")


def _logits(model: Model, features: Column) -> Column:
    """One value per class, already divided by the temperature."""
    scale = 1 / F.sqrt(F.greatest(F.size(features), F.lit(1)).cast("double"))
    values = []
    for bias, weights in zip(model.bias, model.weights, strict=True):
        table = _literal([round(w, 6) for w in weights.tolist()], "double")
        total = F.aggregate(features, F.lit(0.0), _adder(table))
        values.append((F.lit(float(bias)) + scale * total) / model.temperature)
    return F.array(*values)


def _adder(table: Column):
    return lambda done, at: done + F.get(table, at)


def _containment(found: Column, family: str) -> Column:
    """The largest share of a template, and a little more for every pair, so that of equal ones the longest counts."""
    shares = []
    for template in TEMPLATES[family]:
        wanted = _wanted(template)
        shared = F.size(F.array_intersect(found, _literal(wanted, "string")))
        shares.append(shared * F.lit(1 / len(wanted) + PAIR))
    return F.greatest(*shares) if len(shares) > 1 else shares[0]


LINE = "struct<at:int,blank:boolean,words:array<string>>"
GROUP = "struct<at:int,size:int,words:array<string>>"


def _groups(lines: Column, weigh: Callable[[Column], Column]) -> Column:
    """What ``weigh`` leaves of every line and group of neighbouring lines that could be confirmed.

    ``lines`` are LINEs. The groups that begin at a line are weighed before those of the next are made,
    so that a long text full of notices holds the groups of one line at a time.
    """

    def begin(line: Column) -> Column:
        """A line and at most SPAN + 1 lines after it, of which each between takes one word or more."""
        return F.struct(line.alias("line"), F.slice(lines, line["at"] + 2, F.lit(SPAN + 1)).alias("after"))

    def has_cue(found: Column) -> Column:
        return F.array_join(found, " ").rlike(CUES)

    def tail(found: Column) -> Column:
        return F.slice(found, F.greatest(F.size(found) - SPAN, F.lit(0)) + 1, F.lit(SPAN))

    def head(found: Column) -> Column:
        return F.slice(found, 1, SPAN)

    def may_hold(p: Column) -> Column:
        heads = F.flatten(F.transform(p["after"], lambda x: head(x["words"])))
        return has_cue(p["line"]["words"]) | has_cue(F.concat(tail(p["line"]["words"]), heads))

    def extend(p: Column) -> Column:
        at = p["line"]["at"]
        none = F.lit([]).cast(f"array<{GROUP}>")
        start = F.struct(
            F.lit(True).alias("open"), F.lit(0).alias("between"),
            tail(p["line"]["words"]).alias("words"), none.alias("groups"),
        )

        def step(done: Column, line: Column) -> Column:
            group = F.struct(
                at.alias("at"), (line["at"] - at + 1).alias("size"),
                F.concat(done["words"], head(line["words"])).alias("words"),
            )
            between = done["between"] + F.greatest(F.size(line["words"]), F.lit(1))
            longer = F.struct(
                (between < SPAN).alias("open"), between.alias("between"),
                F.concat(done["words"], line["words"]).alias("words"),
                F.concat(done["groups"], F.array(group)).alias("groups"),
            )
            closed = F.struct(
                F.lit(False).alias("open"), done["between"].alias("between"),
                done["words"].alias("words"), done["groups"].alias("groups"),
            )
            return F.when(done["open"] & ~line["blank"], longer).otherwise(closed)

        single = F.struct(at.alias("at"), F.lit(1).alias("size"), p["line"]["words"].alias("words"))
        return F.concat(F.array(single), F.aggregate(p["after"], start, step, lambda done: done["groups"]))

    def weighed(p: Column) -> Column:
        return weigh(F.filter(extend(p), lambda g: has_cue(g["words"])))

    begun = F.filter(F.transform(F.filter(lines, lambda x: ~x["blank"]), begin), may_hold)
    return F.flatten(F.transform(begun, weighed))


NOTICE = "struct<paragraph:int,size:int,family:string,probability:double,share:double,grams:array<string>>"


def _apart(stands: Column) -> Column:
    """Of overlapping NOTICEs the best, and those that hold without the best ones' word pairs."""

    def order(a: Column, b: Column) -> Column:
        out = F.lit(0)
        for x, y in ((b["share"], a["share"]), (a["size"], b["size"]), (a["paragraph"], b["paragraph"])):
            out = F.when(out != 0, out).when(x < y, -1).when(x > y, 1).otherwise(0)
        return out

    def step(done: Column, p: Column) -> Column:
        over = F.filter(
            done,
            lambda q: (q["paragraph"] < p["paragraph"] + p["size"]) & (p["paragraph"] < q["paragraph"] + q["size"]),
        )
        same = F.exists(over, lambda q: q["family"] == p["family"])
        taken = F.flatten(F.transform(over, lambda q: _pairs_of(q["family"])))
        holds = _share(F.array_except(p["grams"], taken), p["family"]) >= CONFIRM
        keep = F.when(F.size(over) == 0, True).when(same, False).otherwise(holds)
        return F.when(keep, F.concat(done, F.array(p))).otherwise(done)

    none = F.lit([]).cast(f"array<{NOTICE}>")
    chosen = F.aggregate(F.array_sort(stands, order), none, step)
    return F.array_sort(
        F.transform(
            chosen,
            lambda p: F.struct(
                *[p[f].alias(f) for f in ("paragraph", "family", "probability")],
                F.least(F.round(p["share"], 4), F.lit(1.0)).alias("share"),
            ),
        )
    )


def _pairs_of(family: Column) -> Column:
    out = F.lit([]).cast("array<string>")
    for name, templates in TEMPLATES.items():
        pairs = _literal(sorted({g for t in templates for g in _wanted(t)}), "string")
        out = F.when(family == name, pairs).otherwise(out)
    return out


def _share(found: Column, family: Column) -> Column:
    share = F.lit(0.0)
    for name in TEMPLATES:
        share = F.when(family == name, _containment(found, name)).otherwise(share)
    return share


def scan(
    docs: DataFrame, model: Model, keep: Iterable[str], text_col: str = "text"
) -> tuple[DataFrame, str]:
    """``keep`` and the licence paragraphs of every document; the frame and their column's name.

    Each has the number of its first line (from 0), family, probability, and share of a template's word pairs.
    """
    keep = list(keep)
    name = free_name(docs.select(*keep), "licenses")
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    lines = F.transform(
        F.split(text, "\n"),
        lambda x, i: F.struct(
            i.alias("at"), x.rlike(r"^\s*$").alias("blank"), _words_column(x).alias("words")
        ).cast(LINE),
    )

    def features(p: Column) -> Column:
        found = _grams_of(p["words"])
        buckets = F.array_distinct(
            F.transform(found, lambda g: F.pmod(F.xxhash64(g), F.lit(BUCKETS)).cast("int"))
        )
        return F.struct(p["at"].alias("at"), p["size"].alias("size"), found.alias("grams"), buckets.alias("buckets"))

    def weigh(p: Column) -> Column:
        logits = _logits(model, p["buckets"])
        return F.struct(p["at"].alias("at"), p["size"].alias("size"), p["grams"].alias("grams"), logits.alias("logits"))

    def classify(p: Column) -> Column:
        best = F.array_max(p["logits"])
        total = F.aggregate(p["logits"], F.lit(0.0), lambda done, v: done + F.exp(v - best))
        family = F.get(_literal(list(CLASSES), "string"), F.array_position(p["logits"], best) - 1)
        top = F.struct((1 / total).alias("p"), family.alias("family"))
        return F.struct(p["at"].alias("at"), p["size"].alias("size"), p["grams"].alias("grams"), top.alias("top"))

    def confirm(p: Column) -> Column:
        return F.struct(
            p["at"].alias("paragraph"), p["size"].alias("size"), p["top"]["family"].alias("family"),
            p["top"]["p"].alias("probability"), _share(p["grams"], p["top"]["family"]).alias("share"),
            p["grams"].alias("grams"),
        ).cast(NOTICE)

    def standing(groups: Column) -> Column:
        # One step after the other, so that nothing is computed twice within a lambda.
        for step in (features, weigh, classify, confirm):
            groups = F.transform(groups, step)
        return F.filter(
            groups,
            lambda p: (p["family"] != UNKNOWN) & (p["probability"] >= CUTOFF) & (p["share"] >= CONFIRM),
        )

    # ``lines`` is bound as a lambda's variable, or every group would split the text again.
    stands = F.get(F.transform(F.array(lines), lambda all_lines: _groups(all_lines, standing)), F.lit(0))
    empty = F.lit([]).cast("array<struct<paragraph:int,family:string,probability:double,share:double>>")
    any_cue = F.lower(text).rlike(CUES)
    return docs.select(*keep, F.when(any_cue, _apart(stands)).otherwise(empty).alias(name)), name
