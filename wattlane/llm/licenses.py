"""Licence notices in texts: a trained paragraph classifier, confirmed by comparison with templates.

A multinomial logistic regression on word 1- and 2-grams is fitted on variants
of the short notices below, on variants and passages of the paragraphs of whole
licences, and on a bounded sample of the corpus's own paragraphs as the unknown
class; its probabilities are calibrated by a temperature fitted on held-out
rows. A paragraph is reported when a licence is likelier than not and it shares
enough n-grams with a template; its family is that of the nearest template, the
likeliest where several are as near.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlane.llm.license_bodies import BODIES

UNKNOWN = "unknown"

# Usual short notices by licence family.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "agpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation.",
        "Licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ),
    "apache": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Licensed under the Apache License, Version 2.0.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Released under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "cc-by": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ),
    "cc-by-nc": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ),
    "cc-by-sa": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ),
    "gpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
        "This work is licensed under the GNU General Public License, version 3.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "lgpl": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License.",
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-only",
    ),
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "SPDX-License-Identifier: MIT",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "proprietary": (
        "All rights reserved.",
        "All rights reserved. No part of this publication may be reproduced without prior written permission.",
        "Unauthorized copying of this file, via any medium, is strictly prohibited. Proprietary and confidential.",
    ),
    "public-domain": (
        "This is free and unencumbered software released into the public domain.",
        "Released into the public domain under CC0 1.0 Universal.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    ),
    "artistic": (
        "Licensed under the Artistic License 2.0.",
        "You may redistribute it under the same terms as Perl itself.",
        "SPDX-License-Identifier: Artistic-2.0",
    ),
    "boost": (
        "Distributed under the Boost Software License, Version 1.0.",
        "See accompanying file LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt",
        "SPDX-License-Identifier: BSL-1.0",
    ),
    "cc": (
        "This work is licensed under a Creative Commons License.",
    ),
    "cc-by-nc-nd": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
        "Licensed under CC BY-NC-ND 4.0.",
        "SPDX-License-Identifier: CC-BY-NC-ND-4.0",
    ),
    "cc-by-nc-sa": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
        "Licensed under CC BY-NC-SA 4.0.",
        "SPDX-License-Identifier: CC-BY-NC-SA-4.0",
    ),
    "cc-by-nd": (
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
        "Licensed under CC BY-ND 4.0.",
        "SPDX-License-Identifier: CC-BY-ND-4.0",
    ),
    "epl": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
        "Licensed under the Eclipse Public License, version 2.0.",
        "SPDX-License-Identifier: EPL-2.0",
    ),
    "gfdl": (
        "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License, Version 1.3 or any later version published by the Free Software Foundation.",
        "Licensed under the GNU Free Documentation License, version 1.3.",
        "SPDX-License-Identifier: GFDL-1.3-or-later",
    ),
    "isc": (
        "Licensed under the ISC License.",
        "SPDX-License-Identifier: ISC",
    ),
    "ncsa": (
        "Released under the University of Illinois/NCSA Open Source License.",
        "SPDX-License-Identifier: NCSA",
    ),
    "ofl": (
        "This Font Software is licensed under the SIL Open Font License, Version 1.1.",
        "SPDX-License-Identifier: OFL-1.1",
    ),
    "unicode": (
        "Licensed under the Unicode License v3.",
        "SPDX-License-Identifier: Unicode-3.0",
    ),
    "zlib": (
        "Licensed under the zlib License.",
        "SPDX-License-Identifier: Zlib",
    ),
}
FAMILIES = (*sorted(TEMPLATES), UNKNOWN)


@dataclass(frozen=True)
class LicenseConfig:
    """``background``: about so many corpus paragraphs, chosen by a hash, are fitted on as the unknown class."""

    background: int = 3_000
    variants: int = 12
    body_variants: int = 2
    passages: int = 4
    vocabulary: int = 20_000
    reg: float = 1e-3
    iterations: int = 40
    min_probability: float = 0.5
    min_overlap: float = 0.6
    #: overlaps this near to the largest are as near
    tie: float = 0.02
    min_common: int = 3
    #: of a paragraph of a whole licence: a passage of five words
    min_common_body: int = 9
    seed: int = 5


_WORD = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*")
_LINE = re.compile(r"[^\n]+")


def terms(paragraph: str) -> list[str]:
    """Distinct words and pairs of neighbouring words of a paragraph, lower case."""

    words = _WORD.findall(paragraph.lower())
    return list(dict.fromkeys([*words, *(f"{a} {b}" for a, b in zip(words, words[1:], strict=False))]))


_ALL = [(f, t, whole) for texts, whole in ((TEMPLATES, False), (BODIES, True)) for f in sorted(texts) for t in texts[f]]
_FAMILY_OF = np.array([FAMILIES.index(f) for f, _, _ in _ALL])
_WHOLE = np.array([whole for _, _, whole in _ALL])
_SIZES = np.array([len(terms(t)) for _, t, _ in _ALL])


def _places() -> dict[str, np.ndarray]:
    """The templates that hold each n-gram."""

    at: dict[str, list[int]] = {}
    for i, (_, text, _) in enumerate(_ALL):
        for t in terms(text):
            at.setdefault(t, []).append(i)
    return {t: np.array(ids) for t, ids in at.items()}


_PLACES = _places()


# Words of any prose; n-grams of these alone confirm nothing.
_COMMON_WORDS = frozenset("a all an and any are as at be by can for from has have if in is it its may no not of on or other out so such "
                          "than that the their them these they this those to under was were which who will with you your".split())


def overlaps(found: list[str], cfg: LicenseConfig) -> np.ndarray:
    """By family, the largest share of the shorter side's n-grams that a paragraph has in common with a template."""

    out = np.zeros(len(FAMILIES) - 1)
    places = [(at, not _COMMON_WORDS.issuperset(t.split())) for t in found if (at := _PLACES.get(t)) is not None]
    ids, telling = [at for at, _ in places], [at for at, content in places if content]
    if telling:
        common = np.bincount(np.concatenate(ids), minlength=len(_ALL))
        enough = common >= np.minimum(np.where(_WHOLE, cfg.min_common_body, cfg.min_common), _SIZES)
        enough &= np.bincount(np.concatenate(telling), minlength=len(_ALL)) > 0
        np.maximum.at(out, _FAMILY_OF, np.where(enough, common / np.minimum(len(found), _SIZES), 0.0))
    return out


def _notices(cfg: LicenseConfig) -> list[tuple[str, str]]:
    """(family, text): each template and variants of it with some words lost and a name or year before or after.

    Of whole licences also passages, as their lines are often broken.
    """

    rng = np.random.default_rng(cfg.seed)
    around = ("", "Copyright 2021 The Authors.", "(c) 2019", "See the LICENSE file.", "Notice:")
    out = []
    for family, text, whole in _ALL:
        words = text.split()
        out.append((family, text))
        for _ in range(cfg.body_variants if whole else cfg.variants):
            kept = [w for w in words if rng.random() > 0.1] or words
            before, after = rng.choice(around, 2)
            out.append((family, f"{before} {' '.join(kept)} {after}".strip()))
        for _ in range(cfg.passages if whole and len(words) > 12 else 0):
            start, length = int(rng.integers(len(words) - 8)), int(rng.integers(8, 17))
            out.append((family, " ".join(words[start : start + length])))
    return out


@dataclass(frozen=True)
class LicenseModel:
    """``index``: place of each n-gram in the rows of ``weights``; logits are divided by ``temperature``."""

    cfg: LicenseConfig
    index: dict[str, int]
    weights: np.ndarray
    intercept: np.ndarray
    temperature: float

    def classify(self, paragraph: str) -> tuple[str, float, float]:
        """(family, probability of any family, overlap with the nearest template); unconfirmed ones are unknown."""

        found = terms(paragraph)
        at = [i for t in found if (i := self.index.get(t)) is not None]
        z = (self.intercept + self.weights[at].sum(axis=0)) / self.temperature
        p = np.exp(z - z.max())
        p /= p.sum()
        probability = float(1 - p[-1])
        if probability < self.cfg.min_probability:
            return UNKNOWN, probability, 0.0
        shared = overlaps(found, self.cfg)
        k = int(np.where(shared >= shared.max() - self.cfg.tie, p[:-1], -1.0).argmax())
        return (FAMILIES[k] if shared[k] >= self.cfg.min_overlap else UNKNOWN), probability, float(shared[k])

    def scan(self, text: Column | str) -> Column:
        """Struct of n_paragraphs and the spans (family, start, end, probability, overlap) of a text column.

        A paragraph is a non-blank line. Null and empty texts have none.
        Paragraphs without any n-gram of a licence are unknown by the intercept.
        """

        span = pa.struct([("family", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                          ("probability", pa.float64()), ("overlap", pa.float64())])
        kind = pa.struct([("n_paragraphs", pa.int64()), ("spans", pa.list_(span))])

        @F.arrow_udf("struct<n_paragraphs:bigint,spans:array<struct<family:string,start:bigint,end:bigint,"
                     "probability:double,overlap:double>>>")
        def scanned(texts: pa.Array) -> pa.Array:
            out = []
            for item in texts:
                n, spans = 0, []
                for m in _LINE.finditer(item.as_py() or ""):
                    if m.group().isspace():
                        continue
                    n += 1
                    family, probability, shared = self.classify(m.group())
                    if family != UNKNOWN:
                        spans.append({"family": family, "start": m.start(), "end": m.end(),
                                      "probability": round(probability, 6), "overlap": round(shared, 6)})
                out.append({"n_paragraphs": n, "spans": spans})
            return pa.array(out, kind)

        return scanned(text)


def _temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits under which held-out labels are likeliest."""

    best, least = 1.0, np.inf
    for t in np.geomspace(0.25, 4.0, 33):
        z = logits / t
        z = z - z.max(axis=1, keepdims=True)
        loss = (np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(z)), labels]).mean()
        if loss < least:
            best, least = float(t), loss
    return best


def train(docs: DataFrame, text: str = "text", cfg: LicenseConfig | None = None) -> LicenseModel:
    """Fit on template variants and about ``background`` paragraphs of ``docs``; without any text, on templates alone.

    A background paragraph that overlaps with a template is left out, as it
    may be a notice. All classes weigh the same. A quarter of the rows is held
    out for the calibration.
    """

    cfg = cfg or LicenseConfig()
    spark: SparkSession = docs.sparkSession
    lines = docs.select(F.explode(F.split(F.col(text), "\n")).alias("text")).where(F.trim("text") != "")
    n = lines.count()
    draw = F.pmod(F.xxhash64("text", F.lit(cfg.seed)), F.lit(1 << 30)) / float(1 << 30)
    sample = lines.distinct().where(draw < min(1.0, cfg.background / n)) if n else lines.limit(0)
    background = [r["text"] for r in sample.collect()]
    background = [(UNKNOWN, t) for t in background if overlaps(terms(t), cfg).max() < 0.5]
    rows = [(float(FAMILIES.index(f)), terms(t), i % 4 == 3) for i, (f, t) in enumerate(_notices(cfg) + sorted(background))]
    if not background:
        rows.append((float(len(FAMILIES) - 1), [], False))
    sizes = np.bincount([int(label) for label, _, _ in rows], minlength=len(FAMILIES))
    rows = [(label, t, h, len(rows) / len(FAMILIES) / float(sizes[int(label)])) for label, t, h in rows]
    data = spark.createDataFrame(rows, "label double, terms array<string>, held boolean, weight double")
    data = data.repartition(2).cache()
    fitted = CountVectorizer(inputCol="terms", outputCol="features", binary=True, minDF=2.0,
                             vocabSize=cfg.vocabulary).fit(data)
    vectors = fitted.transform(data).cache()
    model = LogisticRegression(family="multinomial", weightCol="weight", regParam=cfg.reg,
                               maxIter=cfg.iterations, standardization=False).fit(vectors.where("not held"))
    index = {t: i for i, t in enumerate(fitted.vocabulary)}
    weights, intercept = model.coefficientMatrix.toArray().T.copy(), model.interceptVector.toArray()
    if weights.shape[1] < len(FAMILIES):
        raise ValueError("the fit lost a class")
    held = [(t, int(label)) for label, t, h, _ in rows if h]
    logits = np.stack([intercept + weights[[index[x] for x in t if x in index]].sum(axis=0) for t, _ in held])
    data.unpersist(), vectors.unpersist()
    return LicenseModel(cfg, index, weights, intercept, _temperature(logits, np.array([k for _, k in held])))


def scan_licenses(docs: DataFrame, text: str = "text", cfg: LicenseConfig | None = None) -> DataFrame:
    """``row`` (all columns of the document), n_paragraphs and spans; one row per row of ``docs``, repeated ones too."""

    model = train(docs, text, cfg)
    found = docs.select(F.struct("*").alias("row"), model.scan(F.col(text)).alias("s"))
    return found.select("row", "s.n_paragraphs", "s.spans")
