"""License scan: a trained paragraph classifier over sparse word n-grams, in built-in functions on the main path.

Paragraphs are the lines of a text that have a word. Their distinct words and word pairs are hashed and joined
with a table of weights (as many rows as the templates have n-grams, so it is broadcast); sums per paragraph give
the logits of a multinomial logistic regression over the license families and an *unknown* class. The same join
counts how many word pairs of each template a paragraph holds.

Notices may be wrapped over lines. Lines with no wordless line between them form a block, and at every line end inside
a block the words around it are scored like a paragraph: the last words of the line and the next words of the block, as
many on each side as the longest template has, however short the lines are. A notice found this way counts if no
line of its block is confirmed for its family; it counts once per block and family.

The regression is fitted on the driver from the templates (whole, cut and embedded in other words), from near misses (denied
templates, templates with another name in the place of the license's) and from a bounded sample of paragraphs of the corpus as
the unknown class. The probability a prediction needs is calibrated on a part of the sample that was not learned from, so that
at most one in ``1 / max_false`` unknown paragraphs passes. A prediction is confirmed if the paragraph holds at least
``min_match_pct`` per cent of the word pairs of a template of its family and all distinguishing phrases of that template, and no
denial such as *not licensed*. Short forms (*MIT License*) are confirmed only in paragraphs of a few words more.

The sample holds whole lines and the words around the end of a line and the next one, at most ``max_paragraphs`` of each, those with the
smallest hashes of their texts; a text counts once. It comes to the driver as the template n-grams that it holds, so its size has a
bound whatever the length of the lines.

Defined cases: a null or empty text has no paragraphs and no license; repeated rows are judged one by one; ties
between families go to the first by name; a paragraph names one family at most, the most probable; a paragraph with a denial names
none; an empty table gives an empty result; other columns are not read. A long text is cut into lines, one row each; the lines of a
block (a run of lines without a wordless line) share one row while they are cut, so memory follows the largest block.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Usual wordings by which texts name their license. A match must hold the phrases in brackets.
CC_VERSIONS = (2, 3, 4)


def _creative_commons(short: str, long: str) -> list[str]:
    return [
        form
        for v in CC_VERSIONS
        for form in (
            f"This work is licensed under a Creative [Commons {long} {v}].0 International License",
            f"Licensed under [CC {short} {v}].0",
            f"SPDX-License-Identifier: [CC-{short} {v}].0",
        )
    ]


TEMPLATES = {
    "agpl": [
        "This work is licensed under the GNU [Affero General] Public License, version 3",
        "redistribute it and/or modify it under the terms of the GNU [Affero General] Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: [AGPL]",
    ],
    "apache-2.0": [
        "Licensed under the [Apache] License, Version 2.0",
        "you may not [use this file except] in compliance with the License",
        "distributed under the License is distributed on an [AS IS BASIS], WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND",
        "SPDX-License-Identifier: [Apache]",
    ],
    "bsd": [
        "Licensed under the [BSD] 3-Clause License",
        "Licensed under the [BSD] 2-Clause License",
        "[Redistribution and use in source] and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "[Neither the name of] the copyright holder nor the names of its contributors may be used to endorse or promote products",
        "SPDX-License-Identifier: [BSD]",
    ],
    "cc-by": _creative_commons("BY", "Attribution"),
    "cc-by-nc": _creative_commons("BY-NC", "Attribution-NonCommercial"),
    "cc-by-nc-nd": _creative_commons("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
    "cc-by-nc-sa": _creative_commons("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
    "cc-by-nd": _creative_commons("BY-ND", "Attribution-NoDerivatives"),
    "cc-by-sa": _creative_commons("BY-SA", "Attribution-ShareAlike"),
    "cc0": [
        "Licensed under [CC0] 1.0",
        "dedicated to the public domain under [CC0] 1.0 Universal",
        "the author has [waived all copyright] and related or neighboring rights to this work",
        "SPDX-License-Identifier: [CC0]",
    ],
    "epl": [
        "This program and the accompanying materials are made available under the terms of the [Eclipse Public] License v2.0",
        "Licensed under the [Eclipse Public] License, version 2.0",
        "SPDX-License-Identifier: [EPL]",
    ],
    "gpl": [
        "This work is licensed under the [GNU General] Public License, version 3",
        "redistribute it and/or modify it under the terms of the [GNU General] Public License as published by the Free Software Foundation",
        "Licensed under the GNU [GPL] version 3",
        "Licensed under the [GPLv3]",
        "Licensed under the [GPLv2]",
        "SPDX-License-Identifier: [GPL]",
    ],
    "isc": [
        "Licensed under the [ISC] License",
        "Permission to use, copy, modify, and/or distribute this software for any purpose [with or without fee] is hereby granted",
        "SPDX-License-Identifier: [ISC]",
    ],
    "lgpl": [
        "This work is licensed under the GNU [Lesser General] Public License, version 3",
        "redistribute it and/or modify it under the terms of the GNU [Lesser General] Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: [LGPL]",
    ],
    "mit": [
        "Released under the [MIT] License",
        "Licensed under the [MIT] License",
        "Permission is [hereby granted, free of charge], to any person obtaining a copy of this software and associated documentation files",
        "SPDX-License-Identifier: [MIT]",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the [Mozilla Public] License, v. 2.0",
        "Licensed under the [Mozilla Public] License, version 2.0",
        "SPDX-License-Identifier: [MPL]",
    ],
    "proprietary": [
        "[All rights reserved]",
        "[No part of this] work [may be reproduced] without written permission of the publisher",
    ],
}
SHORT_FORMS = {
    "agpl": ["GNU [Affero General] Public License"], "apache-2.0": ["[Apache License]"], "bsd": ["[BSD] 3-Clause License", "[BSD License]"],
    "cc0": ["[CC0] 1.0 Universal"], "epl": ["[Eclipse Public] License"], "gpl": ["[GNU General] Public License"], "isc": ["[ISC License]"],
    "lgpl": ["GNU [Lesser General] Public License"], "mit": ["[MIT License]"], "mpl": ["[Mozilla Public] License"],
}
DENIALS = [
    *[("not", w) for w in ("licensed", "released", "available", "covered", "under", "subject", "dedicated", "published")],
    *[(w, v) for w in ("never", "formerly", "previously", "longer", "neither") for v in ("licensed", "released", "distributed", "under")],
]
SHORT_FORM_WORDS = 4  # words a paragraph may have beside a short form
SHARED_BY = 4  # words in templates of this many families are no features by themselves, only in pairs
KEY = 64  # a distinguishing n-gram counts this much in a template's count, above all its pairs
UNKNOWN = "unknown"
MAX_PARAGRAPHS = 4000
MIN_MATCH_PCT = 60
MAX_FALSE = 0.001
SEPARATORS = "[^\\p{L}\\p{N}]+"


def _words(text: str) -> list[str]:
    return [w for w in re.split(r"[\W_]+", text.lower()) if w]


def _grams(words: list[str]) -> set[tuple[str, str]]:
    return {(w, "") for w in words} | set(zip(words, words[1:]))


@dataclass
class Template:
    family: str
    words: list[str]
    pairs: set[tuple[str, str]]
    keys: set[tuple[str, str]]  # n-grams a match must hold
    most_words: int  # words of the longest paragraph it may confirm; 0: any

    def holds(self, grams: set[tuple[str, str]], pct: float) -> bool:
        return self.keys <= grams and 100 * len(self.pairs & grams) >= pct * len(self.pairs)


def _template(family: str, text: str, short: bool) -> Template:
    words, keys = _words(text), set()
    for phrase in re.findall(r"\[(.*?)\]", text):
        ws = _words(phrase)
        keys |= set(zip(ws, ws[1:])) if len(ws) > 1 else {(ws[0], "")}
    return Template(family, words, set(zip(words, words[1:])), keys, len(words) + SHORT_FORM_WORDS if short else 0)


def read_templates(templates: dict[str, list[str]] = TEMPLATES, short_forms: dict[str, list[str]] = SHORT_FORMS) -> list[Template]:
    return [
        *[_template(f, t, False) for f in sorted(templates) for t in templates[f]],
        *[_template(f, t, True) for f in sorted(short_forms) if f in templates for t in short_forms[f]],
    ]


def features(templates: list[Template]) -> list[tuple[str, str]]:
    """Word pairs and distinguishing words of the templates, words few families share, and denials."""
    families: dict[str, set[str]] = {}
    for t in templates:
        for w in t.words:
            families.setdefault(w, set()).add(t.family)
    own = {(w, "") for w, fs in families.items() if len(fs) < SHARED_BY}
    return sorted(own.union(DENIALS, *(t.pairs | t.keys for t in templates)))


def triggers(templates: list[Template]) -> list[str]:
    """One word of every template's distinguishing phrases, the one the fewest families use: without any, nothing is confirmed."""
    families: dict[str, set[str]] = {}
    for t in templates:
        for w in t.words:
            families.setdefault(w, set()).add(t.family)
    return sorted({min({w for g in t.keys for w in g if w}, key=lambda w: (len(families[w]), -len(w), w)) for t in templates})


@dataclass
class Model:
    families: list[str]  # with the unknown class last
    grams: list[tuple[str, str]]
    weights: np.ndarray  # grams x classes
    bias: np.ndarray
    threshold: float
    templates: list[Template]
    longest: int  # words of the longest template


def fit(
    paragraphs: list[str] | list[set[tuple[str, str]]], templates: dict[str, list[str]] = TEMPLATES, max_false: float = MAX_FALSE,
    seed: int = 4, min_match_pct: int = MIN_MATCH_PCT,
) -> Model:
    """Multinomial logistic regression on presence of template n-grams; the other half of ``paragraphs`` calibrates.

    Paragraphs come as texts or as the n-grams of :func:`sample_paragraphs`. Those that hold the distinguishing phrases of a template
    and half of what confirms it are no examples of the unknown class.
    """
    forms = read_templates(templates)
    families = [*sorted(templates), UNKNOWN]
    grams = features(forms)
    known, column = set(grams), {g: k for k, g in enumerate(grams)}
    rng = np.random.default_rng(seed)
    units = [(_grams(_words(p)) if isinstance(p, str) else p) & known for p in paragraphs]
    units = [u for u in units if not any(t.holds(u, min_match_pct / 2) for t in forms if not t.most_words)]
    ordered = [sorted(u) for u in units]
    rows, labels = [], []
    for t in forms:
        ws = t.words
        for k in range(24):
            cut = ws if k % 2 or t.most_words else ws[int(rng.integers(0, 2)) : len(ws) - int(rng.integers(0, 2))]
            own = _grams(cut) & known
            if ordered and k % 4 > 1 and not t.most_words:  # words around the notice
                beside = ordered[int(rng.integers(len(ordered)))]
                own = own.union(beside[int(j)] for j in rng.integers(len(beside), size=int(rng.integers(0, 12))) if beside) if beside else own
            if t.keys <= own:
                rows.append(own)
                labels.append(families.index(t.family))
        # Near misses: another name in place of the license's, and denials.
        marked = {w for g in t.keys for w in g}
        rows += [_grams([f"-{w}" if w in marked else w for w in ws]) & known] * 4
        rows += [(_grams(ws) & known) | {DENIALS[int(rng.integers(len(DENIALS)))]} for _ in range(4)]
        labels += [len(families) - 1] * 8
    for u in units[::2]:
        rows.append(u)
        labels.append(len(families) - 1)
    # Pieces of templates that name no license are unknown as well.
    common = sorted({g for g in known if not g[1]}.difference(*(t.keys for t in forms)))
    for _ in range(400):
        rows.append({common[int(k)] for k in rng.integers(len(common), size=int(rng.integers(1, 6)))})
        labels.append(len(families) - 1)

    def matrix(sets):
        x = np.zeros((len(sets), len(grams)), np.float32)
        for k, own in enumerate(sets):
            x[k, [column[g] for g in own]] = 1
        return x

    x, y = matrix(rows), np.eye(len(families), dtype=np.float32)[labels]
    share = y.sum(0)
    cost = (y / np.maximum(share, 1)).sum(1) * len(y) / len(families)
    w, b = np.zeros((len(grams), len(families)), np.float32), np.zeros(len(families), np.float32)
    gw, gb = np.full_like(w, 1e-6), np.full_like(b, 1e-6)
    for _ in range(150):
        z = x @ w + b
        p = np.exp(z - z.max(1, keepdims=True))
        d = (p / p.sum(1, keepdims=True) - y) * cost[:, None] / len(y)
        dw, db = x.T @ d + 1e-4 * w, d.sum(0)
        gw, gb = gw + dw * dw, gb + db * db
        w, b = w - 0.3 * dw / np.sqrt(gw), b - 0.3 * db / np.sqrt(gb)
    threshold = 0.5
    if units[1::2]:
        z = matrix(units[1::2]) @ w + b
        p = np.exp(z - z.max(1, keepdims=True))
        best = (p / p.sum(1, keepdims=True))[:, :-1].max(1)
        threshold = min(0.99, max(0.5, float(np.quantile(best, 1 - max_false))))
    return Model(families, grams, w, b, threshold, forms, max((len(t.words) for t in forms), default=0))


def _lines(text: Column) -> Column:
    """Lines with a word, each as its lower-cased words."""
    lines = F.transform(
        F.split(F.lower(F.coalesce(text, F.lit(""))), "\n", -1), lambda x: F.array_remove(F.split(x, SEPARATORS, -1), "")
    )
    return F.filter(lines, lambda ws: F.size(ws) > 0)


def _blocks(text: Column) -> Column:
    """Runs of lines with no wordless line between them, each as its lines."""
    blocks = F.split(F.coalesce(text, F.lit("")), "\n[^\\p{L}\\p{N}\n]*\n", -1)
    return F.filter(F.transform(blocks, _lines), lambda lines: F.size(lines) > 0)


def _heads(lines: Column, reach: int) -> Column:
    """The first ``reach`` words of every line in one array; an empty word marks a line end."""
    return F.flatten(F.transform(lines, lambda ws: F.concat(F.slice(ws, 1, reach), F.array(F.lit("")))))


def _around_line_ends(lines: Column, heads: Column, reach: int) -> Column:
    """For every line but the last: its last ``reach`` words and the next ``reach`` words of the block.

    ``heads`` is a stored column of :func:`_heads`: inside the lambda an expression would be computed for every line.
    """
    ends = F.filter(F.transform(heads, lambda w, i: F.when(w == "", i)), lambda i: i.isNotNull())
    inner = F.greatest(F.size(lines) - 1, F.lit(0))
    return F.zip_with(
        F.slice(lines, 1, inner), F.slice(ends, 1, inner),
        lambda ws, end: F.concat(
            F.slice(ws, F.greatest(F.size(ws) - (reach - 1), F.lit(1)), reach),
            F.slice(F.array_remove(F.slice(heads, end + 2, 2 * reach), ""), 1, reach),
        ),
    )


def sample_paragraphs(
    docs: DataFrame, text: str = "text", max_paragraphs: int = MAX_PARAGRAPHS, templates: dict[str, list[str]] = TEMPLATES
) -> list[set[tuple[str, str]]]:
    """Template n-grams of at most ``max_paragraphs`` lines and as many line ends of the corpus, the first by hash; a text counts once."""
    forms = read_templates(templates)
    known = F.array(*[F.lit(" ".join(g).strip()) for g in features(forms)])
    reach = max((len(t.words) for t in forms), default=0)
    picked = []
    for ends in (False, True):
        lines = F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)
        after = F.slice(lines, 2, F.size(lines))
        worded = lambda x: F.coalesce(x.rlike("[\\p{L}\\p{N}]"), F.lit(False))
        pairs = F.zip_with(lines, after if ends else F.transform(lines, lambda x: F.lit("")), lambda x, y: F.struct(x.alias("line"), y.alias("next")))
        pairs = F.filter(pairs, lambda u: worded(u["line"]) & (worded(u["next"]) if ends else F.lit(True)))
        keyed = docs.select(F.transform(pairs, lambda u: F.struct(F.xxhash64(u["line"], u["next"]).alias("h"), u["line"].alias("line"), u["next"].alias("next"))).alias("units"))
        # Only hashes are shuffled to find the limit; words are cut for the few texts below it. An inner explode would infer a filter
        # that computes its array a second time.
        hashes = keyed.select(F.explode_outer("units.h").alias("h")).where(F.col("h").isNotNull())
        limit = hashes.distinct().orderBy("h").limit(max_paragraphs).agg(F.max("h")).first()[0]
        if limit is None:
            continue
        few = keyed.select(F.explode_outer(F.filter("units", lambda u: u["h"] <= limit)).alias("u")).where(F.col("u").isNotNull())
        cut = lambda x: F.array_remove(F.split(F.lower(x), SEPARATORS, -1), "")
        ws = few.select(F.col("u.h").alias("h"), cut(F.col("u.line")).alias("ws"), cut(F.coalesce("u.next", F.lit(""))).alias("next"))
        if ends:
            ws = ws.withColumn("ws", F.concat(F.slice("ws", F.greatest(F.size("ws") - (reach - 1), F.lit(1)), reach), F.slice("next", 1, reach)))
        own = F.array_intersect(
            F.concat("ws", F.zip_with("ws", F.slice("ws", 2, F.greatest(F.size("ws"), F.lit(1))), lambda x, y: F.concat_ws(" ", x, y))), known
        )
        picked += ws.select("h", F.array_sort(own).alias("own")).groupBy("h").agg(F.min("own").alias("own")).orderBy("h").collect()
    return [{tuple([*g.split(" "), ""][:2]) for g in r.own} for r in picked]


def scan(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text", min_match_pct: int = MIN_MATCH_PCT) -> DataFrame:
    """Per row: n_paragraphs, n_license, license (the most certain confirmed family, else unknown), probability and families."""
    spark, n = docs.sparkSession, len(model.families)
    # The counts of several templates are fields of one long: pairs below KEY, distinguishing n-grams above; the last field counts denials.
    width, per_long = 10, 6
    denials = set(DENIALS)
    slots = -(-(len(model.templates) + 1) // per_long)

    def counts(gram):
        fields = [(gram in t.pairs) + KEY * (gram in t.keys) for t in model.templates] + [int(gram in denials)]
        return [sum(v << width * k for k, v in enumerate(fields[j * per_long : (j + 1) * per_long])) for j in range(slots)]

    rows = [(a, b, [float(v) for v in model.weights[k]], counts((a, b))) for k, (a, b) in enumerate(model.grams)]
    weights = (
        spark.createDataFrame(rows, "a string, b string, w array<double>, m array<long>")
        .select(
            F.xxhash64("a", "b").alias("gram"), *[F.col("w")[k].alias(f"w{k}") for k in range(n)],
            *[F.col("m")[k].alias(f"m{k}") for k in range(slots)],
        )
    )
    # Every paragraph has the gram 0, which carries the bias, so that none is lost in the join.
    bias = spark.range(1).select(
        F.lit(0).cast("long").alias("gram"), *[F.lit(float(v)).alias(f"w{k}") for k, v in enumerate(model.bias)],
        *[F.lit(0).cast("long").alias(f"m{k}") for k in range(slots)],
    )
    table = F.broadcast(weights.unionByName(bias))
    own = docs.select(F.col(id_col).alias("doc_id"), _blocks(F.col(text)).alias("blocks"), F.monotonically_increasing_id().alias("__row"))
    own = own.select("doc_id", "__row", F.posexplode_outer("blocks").alias("block", "lines"))
    # A template is confirmed only where all its distinguishing phrases are, so only units with one of their words are scored. The others are
    # counted: every block has a unit at no place, which carries its lines.
    words = F.array(*[F.lit(w) for w in triggers(model.templates)])
    own = own.withColumn("told", F.exists("lines", lambda ws: F.arrays_overlap(ws, words)))
    own = own.withColumn("heads", F.when(F.col("told"), _heads(F.col("lines"), model.longest)))
    # Lines have the places 0, 1, ..., the words around their ends -1, -2, ...
    unit = lambda pos, ws, count: F.struct(pos.alias("pos"), ws.alias("ws"), count.alias("count"))
    scored = F.concat(
        F.transform("lines", lambda ws, i: unit(i, ws, F.lit(0))),
        F.transform(_around_line_ends(F.col("lines"), F.col("heads"), model.longest), lambda ws, i: unit(-1 - i, ws, F.lit(0))),
    )
    counted = F.array(unit(F.lit(None).cast("int"), F.array().cast("array<string>"), F.coalesce(F.array_size("lines"), F.lit(0))))
    units = F.when(F.col("told"), F.concat(counted, F.filter(scored, lambda u: F.arrays_overlap(u["ws"], words)))).otherwise(counted)
    own = own.select("doc_id", "__row", "block", F.explode_outer(units).alias("unit"))
    # An inner explode would infer a filter that computes the n-grams a second time.
    grams = own.select("doc_id", "__row", "block", F.col("unit.pos").alias("pos"), F.col("unit.count").alias("count"), F.col("unit.ws").alias("ws")).select(
        "doc_id", "__row", "block", "pos", "count", F.size("ws").alias("n_words"),
        F.explode_outer(F.array_distinct(F.concat(
            F.array(F.lit(0).cast("long")),
            F.transform("ws", lambda w: F.xxhash64(w, F.lit(""))),
            F.zip_with("ws", F.slice("ws", 2, F.greatest(F.size("ws"), F.lit(1))), lambda w, v: F.xxhash64(w, v)),
        ))).alias("gram"),
    )
    sums = grams.join(table, "gram").groupBy("doc_id", "__row", "block", "pos", "count", "n_words").agg(
        *[F.sum(f"w{k}").alias(f"w{k}") for k in range(n)], *[F.sum(f"m{k}").alias(f"m{k}") for k in range(slots)]
    )
    top = F.greatest(*[F.col(f"w{k}") for k in range(n)])
    parts = [F.exp(F.col(f"w{k}") - top) for k in range(n)]
    total = sum(parts[1:], parts[0])
    options = [F.struct((parts[k] / total).alias("p"), F.lit(-k).alias("k")) for k in range(n - 1)]
    best = F.greatest(*options)
    judged = sums.withColumn("best", best).withColumns({"p": F.col("best.p"), "k": -F.col("best.k")})
    field = lambda slot, shift: F.call_function("shiftright", F.get(F.array(*[F.col(f"m{k}") for k in range(slots)]), slot), shift).bitwiseAND(
        F.lit((1 << width) - 1)
    )
    forms = F.array(*[
        F.struct(
            F.lit(model.families.index(t.family)).alias("k"), F.lit(j // per_long).alias("slot"), F.lit(width * (j % per_long)).alias("shift"),
            F.lit(len(t.pairs)).alias("pairs"), F.lit(len(t.keys)).alias("keys"), F.lit(t.most_words or 2**31 - 1).alias("most"),
        )
        for j, t in enumerate(model.templates)
        if t.pairs
    ])
    last = len(model.templates)
    denied = field(F.lit(last // per_long), F.lit(width * (last % per_long))) > 0
    matches = ~denied & F.exists(forms, lambda t: (t["k"] == F.col("k")) & (F.col("n_words") <= t["most"]) & (
        (field(t["slot"], t["shift"]) / KEY).cast("long") == t["keys"]
    ) & (100 * (field(t["slot"], t["shift"]) % KEY) >= min_match_pct * t["pairs"]))
    found = F.col("pos").isNotNull() & (F.col("p") >= model.threshold) & matches
    names = F.array(*[F.lit(f) for f in model.families[:-1]])
    hit = F.struct(F.col("p"), (-F.col("k")).alias("k"))
    judged = judged.select(
        "doc_id", "__row", F.col("count").cast("long").alias("one"),
        F.when(found & (F.col("pos") >= 0), hit).alias("hit"),
        F.when(found & (F.col("pos") >= 0), F.struct("block", -F.col("k"))).alias("place"),
        F.when(found & (F.col("pos") < 0), F.struct("block", -F.col("k"))).alias("wrapped_place"),
        F.when(found & (F.col("pos") < 0), F.struct(F.struct("block", -F.col("k")).alias("place"), hit.alias("hit"))).alias("wrapped"),
    )
    per_row = judged.groupBy("doc_id", "__row").agg(
        F.coalesce(F.sum("one"), F.lit(0)).alias("n_paragraphs"), F.count("hit").alias("n_own"), F.max("hit").alias("own_best"),
        F.collect_set(F.get(names, -F.col("hit.k"))).alias("own_names"),
        F.array_except(F.collect_set("wrapped_place"), F.collect_set("place")).alias("places"), F.collect_list("wrapped").alias("wrapped"),
    )
    spread = F.transform(F.filter("wrapped", lambda x: F.array_contains("places", x["place"])), lambda x: x["hit"])
    return (
        per_row.withColumn("hits", spread)
        .withColumns({
            "best": F.greatest(F.col("own_best"), F.array_max("hits")),
            "__all": F.array_sort(F.array_union("own_names", F.transform("hits", lambda x: F.get(names, -x["k"])))),
        })
        .select(
            "doc_id", "n_paragraphs", (F.col("n_own") + F.size("places")).alias("n_license"),
            F.coalesce(F.get(names, -F.col("best.k")), F.lit(UNKNOWN)).alias("license"),
            F.round(F.coalesce(F.col("best.p"), F.lit(0.0)), 6).alias("probability"),
            F.array_join("__all", ",").alias("families"),
        )
    )
