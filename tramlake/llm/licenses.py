"""Licence scans: a trained classifier of paragraphs, confirmed by comparison with templates.

A line is judged if it has one of the CUES. Its features are its words and word pairs; logistic regressions, one a family and one for
licences of any kind, trained here on NOTICES and ORDINARY, give log-odds from the few features with a weight. The log-odds of
the best family are calibrated on notices that a fold held out. A line whose calibrated probability reaches KNOWN, and that is
like one of the family's templates, is of that family: its likeness, the features that they share over the root of the product of their
numbers, must reach ALIKE, so neither a word of a template nor a template's words scattered in a long line are enough. One that is not, but that the
regression for any kind gives LICENCE or more log-odds, is of family `unknown`. Any other gives no row.

A notice that is part of a line, or wrapped over lines, whatever comment marks they begin with, is found in windows of its paragraph's words
(lines up to one without a word).
Around each of the TELLS, windows of WIDTHS words that overlap are judged as lines are, with the likeness inside the window, ALIKE_INSIDE, and the
log-odds of a family's own features, but only for families whose TELLS they have. A line that is known and has its family's TELLS stays
as it is and bounds the windows; of the windows the best that do not overlap are rows of the line in which they begin, in place of
what the lines under them gave. The SQL below has the lines only: it says the same wherever notices are lines of their own.

Training happens on the driver and sees only the constants below. Scanning is DataFrame work alone: one pass, no shuffle, whole lines
up to any length; only lines with a cue go on to the arithmetic, and only texts with one of the TELLS to windows.

Defined cases: null and empty texts have no paragraphs; each repeated row is scanned by itself; a null doc_id is carried along; other
columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, functions as F

from tramlake.llm.common import LOWER, UPPER

KNOWN, ALIKE, LICENCE = 0.5, 0.45, 1.0
#: Likeness that a window must reach, which is cut out of what stands around it.
ALIKE_INSIDE = 0.55
UNKNOWN = "unknown"
FOLDS, ROUNDS, RATE, KEEP, DECAY, SMALLEST = 5, 150, 3.0, 0.9, 1e-4, 0.25

# What the families are called, usual notices and paragraphs of each, and sentences that only sound alike.
NAMES = {
    "AGPL-3.0": ("GNU Affero General Public License, version 3", "GNU AGPL v3", "Affero General Public License v3.0"),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 license"),
    "BSD": ("BSD 3-Clause License", "BSD 2-Clause License", "BSD license", "BSD-style license"),
    "CC-BY": ("Creative Commons Attribution 4.0 International License", "Creative Commons Attribution License", "CC BY 4.0 license"),
    "CC-BY-NC": ("Creative Commons Attribution-NonCommercial 4.0 International License", "Creative Commons Attribution-NonCommercial-ShareAlike License", "CC BY-NC 4.0 license"),
    "CC-BY-SA": ("Creative Commons Attribution-ShareAlike 4.0 International License", "Creative Commons Attribution-ShareAlike License", "CC BY-SA 4.0 license"),
    "CC0-1.0": ("CC0 1.0 Universal Public Domain Dedication", "Creative Commons CC0 1.0 waiver"),
    "GPL-2.0": ("GNU General Public License, version 2", "GNU GPL v2", "GNU General Public License v2.0"),
    "GPL-3.0": ("GNU General Public License, version 3", "GNU GPL v3", "GNU General Public License v3.0"),
    "ISC": ("ISC License", "ISC license"),
    "LGPL": ("GNU Lesser General Public License, version 3", "GNU LGPL v2.1", "Lesser General Public License v2.1"),
    "MIT": ("MIT License", "MIT license", "MIT/Expat license"),
    "MPL-2.0": ("Mozilla Public License, version 2.0", "Mozilla Public License, v. 2.0", "MPL 2.0 license"),
    "Unlicense": ("Unlicense", "Unlicense public domain dedication"),
}
FORMS = (
    "Licensed under the {}.", "Released under the {}.", "This work is licensed under the {}.", "This project is distributed under the terms of the {}.",
    "The source code is available under the {}, see the file LICENSE.", "Use of this source code is governed by the {} that can be found in the LICENSE file.", "{}",
)
PARAGRAPHS = {
    "AGPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
    ),
    "Apache-2.0": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at',
        "Apache License Version 2.0, January 2004",
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ),
    "CC-BY": ("Licensed under CC BY 4.0.", "This article is distributed under the terms of the Creative Commons Attribution License, which permits unrestricted use, distribution, and reproduction in any medium, provided the original work is properly cited."),
    "CC-BY-NC": ("Licensed under CC BY-NC 4.0.", "Shared under CC BY-NC-SA 4.0 for non-commercial use."),
    "CC-BY-SA": ("Licensed under CC BY-SA 4.0.", "Text is available under the Creative Commons Attribution-ShareAlike License."),
    "CC0-1.0": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.", "This work is dedicated to the public domain under CC0 1.0.",
    ),
    "GPL-2.0": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
        "either version 2 of the License, or (at your option) any later version of the GNU General Public License.",
    ),
    "GPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "Licensed under the GNU General Public License version 3 or later.", "either version 3 of the License, or (at your option) any later version of the GNU General Public License.",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "LGPL": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU Lesser General Public License along with this library.",
    ),
    "MIT": (
        "This code is MIT licensed.", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction.',
        "This software is made available under the terms of the MIT license.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    "Proprietary": (
        "All rights reserved.", "Copyright 2020 Example Corporation. All rights reserved.",
        "No part of this publication may be reproduced or transmitted in any form without the prior written permission of the publisher.",
        "No part of this book may be reproduced, stored in a retrieval system, or transmitted by any means without written permission of the publisher.",
        "Proprietary and confidential. Unauthorized copying of this file is strictly prohibited.", "This document is confidential and proprietary; unauthorized copying or distribution is prohibited.",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
}
IDENTIFIERS = {
    "AGPL-3.0": ("AGPL-3.0-only",), "Apache-2.0": ("Apache-2.0",), "BSD": ("BSD-3-Clause", "BSD-2-Clause"), "CC-BY": ("CC-BY-4.0",), "CC-BY-NC": ("CC-BY-NC-4.0",), "CC-BY-SA": ("CC-BY-SA-4.0",), "CC0-1.0": ("CC0-1.0",),
    "GPL-2.0": ("GPL-2.0-only",), "GPL-3.0": ("GPL-3.0-or-later",), "ISC": ("ISC",), "LGPL": ("LGPL-3.0-only",), "MIT": ("MIT",), "MPL-2.0": ("MPL-2.0",), "Unlicense": ("Unlicense",),
}
ORDINARY = (
    "The driver had to show a licence before the car was released.", "A new version of the program was released under the name of its author.",
    "The general public may use the library on all days of the week.", "All of the rights of the people were reserved to the states.",
    "She works at the MIT laboratory and teaches software design.", "The Apache helicopter was seen over the northern border.",
    "Version 2.0 of the application is now available for download.", "The work was done under the terms of the contract with the city.",
    "The source of the river is in the mountains, and its form changes with the season.", "Any person may obtain a copy of the report from the public office.",
    "The license plate of the van was found in the garden.", "This is a story about the creative work of two common people.", "You may not use this door, except in case of fire.",
    "The commons committee met to discuss the attribution of the painting.", "He was granted permission to leave, free of charge.", "The conditions of use of the park are listed at the gate.",
    "The foundation gives money for free concerts and for the public domain of art.", "Their names and the names of their children were written in the book.",
    "Under the bridge the water is deep, and it is cold in winter.", "In the end the library was moved to a larger building.", "Any later train will arrive after the meeting has ended.",
    "The permission of the owner is needed to enter the house.", "This.", "Of this and all that is in it.", "Er kommt mit dem Zug und mit der Bahn.",
    "Mit und ohne die Kinder, mit allen und als Gast.", "Sie ist mit ihrer Schwester in der Stadt, und er wartet.", "El libro de la casa es para los amigos y las amigas.",
    "La maison de mon ami est dans le village, et il y est bien.", "It is licensed to sell wine and beer until midnight.", "A fee of two euros is charged for each copy of the map.",
    "This file is large and the use of a faster disk is advised.", "The terms of the loan were fair, and it was paid in three years.",
    "MIT", "Apache", "The GNU project began in 1983.", "GNU", "CC", "Mozilla was founded in 1998 and has its seat in California.", "The university, MIT, gave her a license to teach.",
    "Lawyers disagree on what the GNU General Public License says about linking.", "She wrote a book about the history of the MIT License and of free software.",
    "Many firms prefer the Apache License, while others avoid it.", "The public domain is what belongs to nobody and to all.", "The copyright of the song expired in 1995, and all rights went to the state.",
    "He asked for a creative commons where artists share ideas.", "The library has a license for the database, which ends in May.", "Permission to build was granted by the council in spring.",
    "Her pilot's license was renewed for two years.", "The bank charged a license fee of ten euros.", "Redistribution of land was the aim of the reform.", "The publisher gave written permission for the film.",
    "Confidential talks between the two governments began on Monday.", "Copyright law protects the works of authors for seventy years.", "The software was distributed on disks, free of charge, with the magazine.",
)
NOTICES = {
    f: tuple(dict.fromkeys([*(form.format(name) for name in NAMES.get(f, ()) for form in FORMS), *PARAGRAPHS[f], *(f"SPDX-License-Identifier: {x}" for x in IDENTIFIERS.get(f, ()))])) for f in sorted(PARAGRAPHS)
}
#: What a line is compared with: the paragraphs, and each name and identifier in one form.
TEMPLATES = {f: tuple(dict.fromkeys([*(FORMS[0].format(name) for name in NAMES.get(f, ())), *PARAGRAPHS[f], *(f"SPDX-License-Identifier: {x}" for x in IDENTIFIERS.get(f, ()))])) for f in NOTICES}
#: Of these, beginnings of words, every notice has one.
CUES = "licen[cs]e|copyright|copying|rights|permi|redistribut|spdx|domain|unlicense|agpl|lgpl|gpl|cc0|cc by|confidential|publication|version|waived|free to copy"
# What tells a family of notices in windows: one of each list must be there, and nothing of UNLIKE within two words.
TELLS = {
    "AGPL-3.0": (("affero", "agpl"),), "Apache-2.0": (("apache license", "apache 2"),), "BSD": (("bsd", "redistribution and", "to endorse"),),
    "CC-BY": (("cc by", "commons attribution"),), "CC-BY-NC": (("by nc", "attribution noncommercial", "attribution non"),),
    "CC-BY-SA": (("by sa", "attribution sharealike", "attribution share"),), "CC0-1.0": (("cc0", "has waived"),),
    "GPL-2.0": (("gnu general", "gnu gpl", "gpl 2", "gpl v2"), ("version 2", "gpl 2", "gpl v2")),
    "GPL-3.0": (("gnu general", "gnu gpl", "gpl 3", "gpl v3"), ("version 3", "gpl 3", "gpl v3")),
    "ISC": (("isc license", "identifier isc", "purpose with"),), "LGPL": (("lesser general", "lgpl"),), "MIT": (("mit license", "identifier mit", "hereby granted"),),
    "MPL-2.0": (("mozilla public", "mpl"),), "Proprietary": (("rights reserved", "and confidential", "this publication"),), "Unlicense": (("unlicense", "and unencumbered"),),
}
UNLIKE = {
    "CC-BY": ("by nc", "by sa", "by nd", "attribution noncommercial", "attribution non", "attribution sharealike", "attribution share"),
    "CC-BY-SA": ("by nc", "attribution noncommercial", "attribution non"),
}
#: Words of a window; windows of a width begin at this many places around one of the TELLS.
WIDTHS, PLACES = (6, 9, 14, 21, 32, 48), 6


def grams(text: str) -> list[str]:
    """Distinct words (runs of a-z and 0-9 after lower-casing A-Z) and pairs of neighbours."""
    lowered = text.translate(str.maketrans(UPPER, LOWER))
    words = "".join(c if "a" <= c <= "z" or "0" <= c <= "9" else " " for c in lowered).split()
    return [*dict.fromkeys([*words, *(f"{a} {b}" for a, b in zip(words, words[1:], strict=False))])]


def _sums(rows: list[list[int]], w: np.ndarray) -> np.ndarray:
    """Of each row of feature numbers the sum of their weights over the root of their number, and the bias, which is the last."""
    at = np.concatenate([np.array(r) for r in rows])
    size = np.array([len(r) for r in rows])
    return np.add.reduceat(w[at], np.cumsum(size) - size) / np.sqrt(size)[:, None] + w[-1]


def _fit(rows: list[list[int]], y: np.ndarray, features: int) -> np.ndarray:
    """Weights, the bias last, of a logistic regression a column of y, where the rarer side of each weighs as much as the other."""
    size = np.array([len(r) for r in rows])
    at, row = np.concatenate([np.array(r) for r in rows]), np.repeat(np.arange(len(rows)), size)
    order = np.argsort(at, kind="stable")
    seen, start = np.unique(at[order], return_index=True)
    row, value = row[order], (1 / np.sqrt(size))[row[order]][:, None]
    w = step = np.zeros((features + 1, y.shape[1]))
    share = np.where(y > 0, 0.5 / np.maximum(y.sum(axis=0), 1), 0.5 / np.maximum((1 - y).sum(axis=0), 1))
    for _ in range(ROUNDS):
        off = (1 / (1 + np.exp(-_sums(rows, w))) - y) * share
        slope = DECAY * w
        slope[seen] += np.add.reduceat(off[row] * value, start)
        slope[-1] += off.sum(axis=0)
        step = KEEP * step - RATE * slope
        w = w + step
    return w


@lru_cache
def model() -> dict:
    """families, vocabulary, weights and bias (a row a family, the last for any; rounded), slope and shift of the calibration, each family's own features and templates."""
    families = sorted(NOTICES)
    texts = [(t, k) for k, name in enumerate(families) for t in NOTICES[name]] + [(t, -1) for t in ORDINARY]
    found = [grams(t) for t, _ in texts]
    vocabulary = sorted({g for each in found for g in each})
    at = {g: k for k, g in enumerate(vocabulary)}
    rows, y = [[at[g] for g in each] for each in found], np.zeros((len(texts), len(families)))
    for r, (_, k) in enumerate(texts):
        if k >= 0:
            y[r, k] = 1
    # Platt's scaling: the best family's log-odds on held-out paragraphs against whether that family is right.
    odds, right = [], []
    for fold in range(FOLDS):
        out = np.arange(len(texts)) % FOLDS == fold
        w = _fit([r for r, o in zip(rows, out, strict=True) if not o], y[~out], len(vocabulary))
        z = _sums([r for r, o in zip(rows, out, strict=True) if o], w)
        odds += z.max(axis=1).tolist()
        right += y[out][np.arange(out.sum()), z.argmax(axis=1)].tolist()
    z, t = np.array(odds), np.array(right)
    t = np.where(t > 0, (t.sum() + 1) / (t.sum() + 2), 1 / ((1 - t).sum() + 2))
    slope, shift = 1.0, 0.0
    for _ in range(2000):
        off = 1 / (1 + np.exp(-(slope * z + shift))) - t
        slope, shift = slope - 0.05 * float((off * z).mean()), shift - 0.05 * float(off.mean())
    w = _fit(rows, np.hstack([y, y.sum(axis=1, keepdims=True)]), len(vocabulary))
    keep = [k for k in range(len(vocabulary)) if np.abs(w[k]).max() >= SMALLEST]
    return {
        "families": families, "vocabulary": [vocabulary[k] for k in keep], "weights": np.round(w[keep].T, 4).tolist(), "bias": np.round(w[-1], 4).tolist(),
        "slope": round(slope, 4), "shift": round(shift, 4), "own": [{g for t in NOTICES[f] for g in grams(t)} for f in families],
        "templates": [[grams(t) for t in TEMPLATES[f]] for f in families],
    }


def _listed(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


def scan(docs: DataFrame) -> DataFrame:
    """A row a licence notice: doc_id, paragraph (number from 0 of the line it begins in), family, score (calibrated), likeness to the family's notices, line."""
    m = model()
    # Constants that the optimizer folds to one array each; as lists of literals they would slow down planning.
    texts = lambda row: f"split('{'|'.join(row)}', '[|]')"
    numbers = lambda row: f"cast({texts(map(str, row))} AS array<double>)"
    array = lambda parts: f"array({', '.join(parts)})"
    # A name for a value inside an expression: whatever the optimizer copies or pushes down, each value is computed once.
    let = lambda name, value, body: f"transform(array({value}), {name} -> {body})[0]"
    words_of = lambda line: f"regexp_extract_all(translate({line}, '{UPPER}', '{LOWER}'), '[a-z0-9]+', 0)"
    grams_of = lambda words: f"array_distinct(concat({words}, transform(slice({words}, 2, size({words})), (w, i) -> concat({words}[i], ' ', w))))"
    families, templates = len(m["families"]), array(array(map(texts, of)) for of in m["templates"])
    places = f"transform(hits, g -> cast(array_position({texts(m['vocabulary'])}, g) AS int))"
    odds_of = lambda weights, bias: f"zip_with({array(map(numbers, weights))}, {numbers(bias)}, (w, b) -> aggregate(places, 0D, (s, p) -> s + w[p - 1]) / sqrt(size(grams)) + b)"
    best = f"""named_struct(
        'best', cast(array_position(odds, top) AS int), 'any', odds[{families}], 'score', round(1 / (1 + exp(-({m['slope']}D * top + {m['shift']}D))), 6),
        'likeness', round(array_max(transform({templates}[cast(array_position(odds, top) AS int) - 1], t -> size(array_intersect(grams, t)) / sqrt(size(grams) * size(t)))), 6))"""
    judged = let("places", places, let("odds", odds_of(m["weights"], m["bias"]), let("top", f"array_max(slice(odds, 1, {families}))", best)))
    hits = f"filter(grams, g -> g IN ({_listed(m['vocabulary'])}))"
    found = let("words", words_of("line"), let("grams", grams_of("words"), let("hits", hits, f"CASE WHEN size(hits) > 0 THEN {judged} END")))
    found = f"CASE WHEN translate(line, '{UPPER}', '{LOWER}') RLIKE '{CUES}' THEN {found} END"
    sure = lambda v, alike=ALIKE: f"{v}.score >= {KNOWN}D AND {v}.likeness >= {alike}D"
    lines = f"filter(transform(lines, (line, k) -> named_struct('k', k, 'found', {found})), v -> v.found.any >= {LICENCE}D OR {sure('v.found')})"

    # Texts with one of the TELLS. Which families have theirs among grams, with context around:
    has = lambda name, f: " AND ".join([f"arrays_overlap({name}, {texts(one)})" for one in TELLS[f]] + [f"NOT arrays_overlap(context, {texts(UNLIKE[f])})" for _ in [f] if f in UNLIKE])
    told_of = lambda name: array(has(name, f) for f in m["families"])
    first = list(dict.fromkeys(t for f in m["families"] for t in TELLS[f][0]))
    # A family's own features alone: the others tell it from families, which the TELLS do here.
    own = [[x if g in t else 0.0 for x, g in zip(w, m["vocabulary"], strict=True)] for w, t in zip(m["weights"], m["own"], strict=False)]
    around = "concat(slice(before, greatest(1, size(before) - 1), 2), line_words, slice(after, 1, 2))"
    told_line = let("line_words", "words_in[v.k]", let("before", "coalesce(get(words_in, v.k - 1), split('', 'x'))", let("after", "coalesce(get(words_in, v.k + 1), split('', 'x'))", let("near", around,
        let("context", grams_of("near"), let("grams", grams_of("line_words"), f"{told_of('grams')}[v.found.best - 1]"))))))
    told = f"transform(filter(verdicts, v -> {sure('v.found')} AND {told_line}), v -> v.k)"
    at = f"CASE WHEN w IN ({_listed(first)}) OR concat(w, ' ', coalesce(get(all_words, i + 1), '')) IN ({_listed(first)}) THEN i END"
    anchors = f"filter(transform(all_words, (w, i) -> {at}), i -> i IS NOT NULL AND NOT bars[line_of[i]])"
    reach = max(WIDTHS) - 1
    # The words from low up to high that share the paragraph, and are in reach.
    back, ahead = f"greatest(0, i - {reach})", f"least(size(all_words) - 1, i + {reach})"
    above = f"coalesce(array_max(filter(sequence(line_of[{back}], line_of[i]), l -> bars[l])), -1)"
    below = f"coalesce(array_min(filter(sequence(line_of[i], line_of[{ahead}]), l -> bars[l])), size(lines))"
    low = f"i - size(filter(slice(line_of, {back} + 1, i - {back}), l -> l > above))"
    high = f"i + size(filter(slice(line_of, i + 1, {reach + 1}), l -> l < below))"
    spans = sorted({(-j * (n // PLACES), n - j * (n // PLACES)) for n in WIDTHS for j in range(PLACES)})
    windows = f"array_distinct(transform({array(f'struct({a} AS a, {b} AS b)' for a, b in spans)}, x -> struct(greatest(low, i + x.a) AS low, least(high, i + x.b) AS high)))"
    verdict = f"""named_struct('score', round(1 / (1 + exp(-({m['slope']}D * top + {m['shift']}D))), 6),
        'likeness', round(array_max(transform({templates}[cast(array_position(odds, top) AS int) - 1], t -> size(array_intersect(grams, t)) / sqrt(size(grams) * size(t)))), 6),
        'low', x.low, 'high', x.high, 'best', cast(array_position(odds, top) AS int))"""
    masked = let("told", told_of("grams"), f"CASE WHEN exists(told, t -> t) THEN {let('hits', hits, let('places', places, let('odds', f'zip_with(told, {odds_of(own, m["bias"][:families])}, (t, o) -> IF(t, o, -1000D))', let('top', 'array_max(odds)', verdict))))} END")
    window = let("words", "slice(all_words, x.low + 1, x.high - x.low)", let("near", "slice(all_words, greatest(low, x.low - 2) + 1, least(high, x.high + 2) - greatest(low, x.low - 2))",
        let("context", grams_of("near"), let("grams", grams_of("words"), masked))))
    each = f"array_max(filter(transform({windows}, x -> {window}), v -> {sure('v', ALIKE_INSIDE)}))"
    each = let("above", above, let("below", below, let("low", low, let("high", high, each))))
    ranked = f"reverse(array_sort(array_distinct(filter(transform(anchors, i -> {each}), v -> v IS NOT NULL))))"
    apart = "aggregate(ranked, slice(ranked, 1, 0), (kept, x) -> IF(exists(kept, y -> y.low < x.high AND x.low < y.high), kept, concat(kept, array(x))))"
    row = lambda k, family, v: f"named_struct('paragraph', {k}, 'family', {family}, 'score', {v}.score, 'likeness', {v}.likeness, 'line', lines[{k}])"
    named = lambda v: f"{texts(m['families'])}[{v}.best - 1]"
    of_line = row("v.k", f"CASE WHEN {sure('v.found')} THEN {named('v.found')} ELSE '{UNKNOWN}' END", "v.found")
    uncovered = "array_contains(told_lines, v.k) OR NOT exists(kept_windows, x -> v.k BETWEEN line_of[x.low] AND line_of[x.high - 1])"
    merged = f"concat(transform(filter(verdicts, v -> {uncovered}), v -> {of_line}), transform(kept_windows, x -> {row('line_of[x.low]', named('x'), 'x')}))"
    merged = let("ranked", ranked, let("kept_windows", apart, merged))
    merged = let("told_lines", told, let("bars", "transform(words_in, (ws, k) -> size(ws) = 0 OR array_contains(told_lines, k))", let("anchors", anchors, merged)))
    merged = let("words_in", f"transform(lines, line -> {words_of('line')})", let("all_words", "flatten(words_in)", let("line_of", "flatten(transform(words_in, (ws, k) -> array_repeat(k, size(ws))))", merged)))
    marked = "(?i)(?<![a-zA-Z0-9])(" + "|".join(t.replace(" ", "[^a-zA-Z0-9]+") for t in first) + ")"
    rows = let("lines", "split(text, '\n')", let("verdicts", lines, f"CASE WHEN text RLIKE '{marked}' THEN {merged} ELSE transform(verdicts, v -> {of_line}) END"))
    rows = f"CASE WHEN translate(text, '{UPPER}', '{LOWER}') RLIKE '{CUES}' THEN {rows} END"
    out = docs.select("doc_id", F.explode(F.expr(rows)).alias("notice"))
    return out.select("doc_id", F.col("notice.paragraph").cast("long").alias("paragraph"), "notice.family", "notice.score", "notice.likeness", "notice.line")


def query(docs: DataFrame) -> DataFrame:
    return scan(docs).drop("line")


def sql() -> str:
    m = model()
    quoted = lambda words: "[" + _listed(words) + "]"
    return f"""
WITH model AS (SELECT {quoted(m['vocabulary'])} AS vocabulary, {m['weights']}::DOUBLE[][] AS weights, {m['bias']}::DOUBLE[] AS bias,
  {quoted(m['families'])} AS families, [{', '.join('[' + ', '.join(map(quoted, of)) + ']' for of in m['templates'])}] AS templates),
lines AS (
  SELECT doc_id, unnest(range(0, len(l))) AS paragraph, unnest(l) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL)),
worded AS (
  SELECT doc_id, paragraph, regexp_extract_all(lowered, '[a-z0-9]+') AS words FROM (SELECT *, translate(line, '{UPPER}', '{LOWER}') AS lowered FROM lines) WHERE regexp_matches(lowered, '{CUES}')),
grammed AS (
  SELECT doc_id, paragraph, list_distinct(list_concat(words, list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]))) AS grams
  FROM worded WHERE len(words) > 0),
hit AS (
  SELECT doc_id, paragraph, grams, list_transform(list_filter(grams, lambda g: list_contains(vocabulary, g)), lambda g: list_position(vocabulary, g)) AS places
  FROM grammed, model WHERE list_has_any(grams, vocabulary)),
scored AS (
  SELECT doc_id, paragraph, grams, families, templates,
         list_transform(range(1, len(bias) + 1), lambda f: list_sum(list_transform(places, lambda p: weights[f][p])) / sqrt(len(grams)) + bias[f]) AS odds
  FROM hit, model),
best AS (
  SELECT doc_id, paragraph, grams, families, templates, list_position(odds, list_max(odds[1 : len(families)])) AS best, odds[len(families) + 1] AS "any",
         round(1 / (1 + exp(-({m['slope']}::DOUBLE * list_max(odds[1 : len(families)]) + {m['shift']}::DOUBLE))), 6) AS score
  FROM scored),
alike AS (
  SELECT *, round(list_max(list_transform(templates[best], lambda t: len(list_intersect(grams, t)) / sqrt(len(grams) * len(t)))), 6) AS likeness FROM best)
SELECT doc_id, paragraph::BIGINT AS paragraph,
       CASE WHEN score >= {KNOWN} AND likeness >= {ALIKE} THEN families[best] ELSE '{UNKNOWN}' END AS family, score, likeness
FROM alike WHERE "any" >= {LICENCE} OR score >= {KNOWN} AND likeness >= {ALIKE}
"""
