"""Licence scan: a trained paragraph classifier over sparse word n-grams.

Every paragraph (line) of every whole text, and every run of adjacent lines that a
wrapped notice may fill, is classified by a multinomial
logistic regression over word 1-, 2- and 3-grams into licence families or
``unknown``. It is trained on the licence notices below in many variants; ``unknown`` are
ordinary lines of a bounded sample of documents, notices of licences outside
the families, prose that names licences, and notices that are denied ("is not released under").
A temperature fitted on lines that are worded otherwise, and on held-out variants, calibrates the
probabilities. What is classified is the stretch that may be a notice, with ``BEFORE`` words before
and ``AFTER`` behind it, so a long line does not drown it.

A prediction counts only if it is confirmed by comparison with the
family's templates: the share of a template's 2-grams that a stretch of at most ``SPREAD``
times its words holds must reach ``CONFIRM``, and the stretch must name the family, its version
where the family is one version, unless the template is a sentence of the licence's body.
A run ends at a blank line, has fewer words
between its first and last line than the longest stretch, and counts only where it holds
more of a template than without its first or its last line. Of finds of one family that share
lines the most similar counts, then the shortest. An ``SPDX-License-Identifier`` line is a
paragraph of its own; each identifier of its expression is classified, exceptions behind WITH are not.
A find carries the version that the notice names ("2.1", "3+" where later ones are allowed), if any.

Defined results: null and empty texts have no paragraphs and no licences; very
long paragraphs are read whole; repeated rows are scanned one by one; with an empty
table the model is trained on the notices alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNKNOWN, CONFIRM, SURE = "unknown", 0.6, 0.5
#: Bounds of the training sample: documents whose lines are ordinary paragraphs, lines of each,
#: characters of each, and words that pad the variants of notices.
SAMPLE_DOCS, SAMPLE_LINES, SAMPLE_CHARS, SAMPLE_WORDS = 400, 5, 400, 5000
#: A template's words may be spread over this many times its length.
SPREAD = 1.4
#: Words before and after a likely notice that are classified with it, and words behind it that may give its version.
BEFORE, AFTER, VERSION_AFTER = 8, 4, 20
#: Families whose notices name no version.
UNVERSIONED = frozenset({"BSD", "ISC", "MIT", "Unlicense"})

#: Notices that name a licence. A find must name it too, see ``NAMES``.
NOTICES = {
    "AGPL": ["Licensed under the GNU Affero General Public License, version 3.", "This program is licensed under the AGPL v3.",
             "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation."],
    "Apache-1.1": ["Licensed under the Apache License, Version 1.1.", "Licensed under the Apache Software License, Version 1.1.", "This project is released under the Apache 1.1 license."],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
                   "This project is released under the Apache 2.0 license.", "Apache License Version 2.0, January 2004."],
    "BSD": ["Released under the BSD 3-Clause License.", "Licensed under the BSD 2-Clause License.", "Distributed under the BSD license.", "Use of this source code is governed by a BSD-style license."],
    "CC-BY": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-NC-ND": ["Licensed under CC BY-NC-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."],
    "CC-BY-NC-SA": ["Licensed under CC BY-NC-SA 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."],
    "CC-BY-ND": ["Licensed under CC BY-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."],
    "CC-BY-SA": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC0": ["Released into the public domain under CC0 1.0.", "To the extent possible under law, the author has waived all copyright under the CC0 1.0 Universal Public Domain Dedication."],
    "EPL": ["Licensed under the Eclipse Public License, version 2.0.",
            "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at"],
    "GPL": ["This work is licensed under the GNU General Public License, version 3.", "Licensed under the GNU General Public License, version 2 or later.", "Licensed under the GPL, version 2.",
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation."],
    "ISC": ["Released under the ISC License.", "Licensed under the ISC license."],
    "LGPL": ["Licensed under the GNU Lesser General Public License, version 3.", "Licensed under the LGPL, version 2.1 or later.",
             "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation."],
    "MIT": ["Released under the MIT License.", "Licensed under the MIT license.", "This project is distributed under the terms of the MIT license."],
    "MPL-2.0": ["Licensed under the Mozilla Public License, version 2.0.", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "Unlicense": ["Released under the Unlicense.", "This project is in the public domain under the Unlicense."],
}
#: Sentences of licence bodies, which name no licence.
BODIES = {
    "Apache-2.0": ["Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."],
    "BSD": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
            "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
            "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "MIT": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
            "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
            "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."],
    "Unlicense": ["This is free and unencumbered software released into the public domain.",
                  "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."],
}
#: Identifiers of the families in ``SPDX-License-Identifier`` lines.
SPDX = {
    "AGPL": ["AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later"],
    "Apache-1.1": ["Apache-1.1"],
    "Apache-2.0": ["Apache-2.0"],
    "BSD": ["BSD-2-Clause", "BSD-3-Clause", "BSD-4-Clause"],
    "CC-BY": ["CC-BY-3.0", "CC-BY-4.0"],
    "CC-BY-NC": ["CC-BY-NC-3.0", "CC-BY-NC-4.0"],
    "CC-BY-NC-ND": ["CC-BY-NC-ND-3.0", "CC-BY-NC-ND-4.0"],
    "CC-BY-NC-SA": ["CC-BY-NC-SA-3.0", "CC-BY-NC-SA-4.0"],
    "CC-BY-ND": ["CC-BY-ND-3.0", "CC-BY-ND-4.0"],
    "CC-BY-SA": ["CC-BY-SA-3.0", "CC-BY-SA-4.0"],
    "CC0": ["CC0-1.0"],
    "EPL": ["EPL-1.0", "EPL-2.0"],
    "GPL": ["GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later"],
    "ISC": ["ISC"],
    "LGPL": ["LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later"],
    "MIT": ["MIT"],
    "MPL-2.0": ["MPL-2.0"],
    "Unlicense": ["Unlicense"],
}
_CC = r"\b(?:cc[ -]by|creative commons attribution)"
#: How a find that no body confirms must name its family, in lower-case words.
NAMES = {
    "AGPL": r"\baffero general public licen[cs]e|\bagpl",
    "Apache-1.1": r"\bapache(?: software)?(?: licen[cs]e)?(?: version| v)?[ -]v?1\.1\b",
    "Apache-2.0": r"\bapache(?: software)?(?: licen[cs]e)?(?: version| v)?[ -]v?2(?:\.0)?(?![.\w])",
    "BSD": r"\bbsd",
    "CC-BY": _CC + r"(?![ -](?:n[cd]|sa|non|no[ -]|noder|share))",
    "CC-BY-NC": _CC + r"[ -](?:nc|non-?commercial)(?![ -](?:n[cd]|sa|no[ -]|noder|share))",
    "CC-BY-NC-ND": _CC + r"[ -](?:nc|non-?commercial)[ -](?:nd|no-?deriv\w*)",
    "CC-BY-NC-SA": _CC + r"[ -](?:nc|non-?commercial)[ -](?:sa|share-?alike)",
    "CC-BY-ND": _CC + r"[ -](?:nd|no-?deriv\w*)",
    "CC-BY-SA": _CC + r"[ -](?:sa|share-?alike)",
    "CC0": r"\bcc0\b",
    "EPL": r"\beclipse public licen[cs]e|\bepl\b",
    "GPL": r"(?<!lesser )(?<!library )(?<!affero )\bgeneral public licen[cs]e|\bgpl",
    "ISC": r"\bisc\b",
    "LGPL": r"\b(?:lesser|library) general public licen[cs]e|\blgpl",
    "MIT": r"\bmit\b",
    "MPL-2.0": r"\bmozilla public licen[cs]e(?: version| v)?[ -.]*v?2(?:\.0)?(?![.\w])|\bmpl[ -]2",
    "Unlicense": r"\bunlicense\b",
}
#: Notices that name no family above, and prose about licences.
OTHERS = ["All rights reserved.", "Licensed under the terms of the vendor agreement.", "This work is licensed to its owner, see the contract.", "Released under a custom license.",
          "The license of this driver was renewed.", "Licensed dealers sell it in version 3.", "General public meeting, version 2.", "You may not use this file.", "Copyright 2020, all rights reserved.",
          "Licensed under the Artistic License, version 2.0.", "Distributed under the Boost Software License, version 1.0.", "Released under the zlib license.", "Licensed under the Microsoft Public License.",
          "Licensed under the GNU Free Documentation License, version 1.3.", "This program is proprietary software; you may not redistribute it or modify it.", "Licensed under the Common Public License, version 1.0.",
          "The MIT license is shorter than the GPL.", "He compared the Apache License with the BSD license.", "She wrote an essay about the GNU General Public License.", "The court read the Mozilla Public License.",
          "The MIT license plate was stolen.", "He studied at MIT and released a film.", "Unlike the Apache License, version 2.0, it has no patent clause.", "Many projects choose a Creative Commons license.",
          "Permission is hereby refused.", "Any person obtaining a copy of the key must sign.", "The software was released in the spring."]
#: Ways to say that a notice does not hold; a notice behind one is unknown.
DENIALS = ["This is not", "It was never", "The code is not", "It is no longer", "Nothing here is", "We do not say that it is", "It used to be"]
#: Lines that only calibrate, worded apart from the notices above.
CHECKS = [("Use and copying are governed by the MIT license found in the LICENSE file.", "MIT"), ("Available under the terms of the Apache License, Version 2.0, see the NOTICE file.", "Apache-2.0"),
          ("You can use it under the GNU Lesser General Public License, version 2.1.", "LGPL"), ("Covered by the GNU Affero General Public License version 3.", "AGPL"),
          ("Source is available under the BSD 3-Clause License.", "BSD"), ("Text and pictures are licensed under CC BY-SA 3.0.", "CC-BY-SA"), ("The pictures are under CC BY-NC 4.0.", "CC-BY-NC"),
          ("You may copy it under the GNU General Public License, version 2.", "GPL"), ("Subject to the Mozilla Public License, version 2.0.", "MPL-2.0"), ("Made available under the Eclipse Public License 2.0.", "EPL"),
          ("The talk about the MIT license was long.", UNKNOWN), ("That is not licensed under the Apache License, Version 2.0.", UNKNOWN), ("Her driving license was not renewed.", UNKNOWN),
          ("Lawyers read the GNU General Public License aloud.", UNKNOWN), ("The software was never released under the BSD license.", UNKNOWN), ("No person is granted a copy of this software.", UNKNOWN),
          ("The band released an album under the name Apache.", UNKNOWN), ("Students of MIT need a license.", UNKNOWN)]

SPDX_MARK = "spdx-license-identifier"
TEMPLATES = {f: [*NOTICES[f], *BODIES.get(f, [])] for f in NOTICES}

_WORD = re.compile(r"[^\W_]+(?:[.-]\w+)*")
_NAMED = {f: re.compile(p) for f, p in NAMES.items()}
_VERSION = re.compile(r"(?:version |\bv ?|-|by(?:-\w+)* |license )(\d+(?:\.\d+)?)(?![.\w]|-clause)|\b(?:apache|agpl|gpl|lgpl|mpl|epl|attribution\S*|cc0) (\d+(?:\.\d+)?)\b")
_LATER = re.compile(r"\bor[ -](?:\(?at your option\)? )?(?:any )?later\b|\bany later version\b")


def words_of(paragraph: str) -> list[str]:
    return _WORD.findall(paragraph.lower())


def grams(paragraph: str) -> set[str]:
    words = words_of(paragraph)
    return {*words, *map(" ".join, zip(words, words[1:], strict=False)), *map(" ".join, zip(words, words[1:], words[2:], strict=False))}


@dataclass
class LicenceModel:
    families: list[str]  # with UNKNOWN last
    vocabulary: dict[str, int]
    words: frozenset[str]  # the 1-grams of the vocabulary
    weights: np.ndarray  # grams x families
    bias: np.ndarray
    temperature: float = 1.0

    def active(self, words: list[str]) -> list[int]:
        """Places of the vocabulary's n-grams in the words of a paragraph."""
        if self.words.isdisjoint(words):
            return []
        get, n = self.vocabulary.get, len(words)
        at = {get(w) for w in words}
        at |= {get(a + " " + b) for a, b in zip(words, words[1:], strict=False) if a in self.words and b in self.words}
        at |= {get(f"{words[i]} {words[i + 1]} {words[i + 2]}") for i in range(n - 2) if words[i] in self.words and words[i + 1] in self.words and words[i + 2] in self.words}
        return sorted(at - {None})

    def probabilities(self, active: list[int]) -> np.ndarray:
        z = (self.weights[active].sum(0) / np.sqrt(max(len(active), 1)) + self.bias) / self.temperature
        z = np.exp(z - z.max())
        return z / z.sum()


def _variants(rng: np.random.Generator, notice: str, filler: list[str], n: int) -> list[str]:
    out = [notice]
    for _ in range(n - 1):
        words = [w for w in notice.split() if rng.random() > 0.06] or notice.split()
        pad = [filler[i] for i in rng.integers(0, len(filler), rng.integers(0, 12))] if filler else []
        at = int(rng.integers(0, len(pad) + 1))
        out.append(" ".join([*pad[:at], *words, *pad[at:]]))
    return out


def fit(lines: list[str], seed: int = 5, epochs: int = 30, rate: float = 0.5) -> LicenceModel:
    """Train on the notices, on denied notices and on ordinary ``lines``; calibrate on ``CHECKS`` and on held-out rows."""
    rng = np.random.default_rng(seed)
    families = [*sorted(TEMPLATES), UNKNOWN]
    place = {f: k for k, f in enumerate(families)}
    filler = [w for line in lines for w in line.split()][:SAMPLE_WORDS]
    rows = [(v, place[f]) for f in families[:-1] for t in TEMPLATES[f] for v in _variants(rng, t, filler, 30)]
    marks = [(f"{SPDX_MARK}: {x}", place[f]) for f in families[:-1] for x in SPDX[f]]
    denied = [f"{d} {t[0].lower()}{t[1:]}" for ts in NOTICES.values() for t in ts for d in DENIALS]
    rows += [r for r in marks for _ in range(8)] + [(t, place[UNKNOWN]) for t in denied]
    rows += [(v, place[UNKNOWN]) for t in OTHERS for v in _variants(rng, t, filler, 20)]
    rows += [(line, place[UNKNOWN]) for line in lines]
    known = sorted(set().union(*(grams(t) for t in [*(t for ts in TEMPLATES.values() for t in ts), *(t for t, _ in marks), *denied, *OTHERS])))
    vocabulary = {g: i for i, g in enumerate(known)}
    model = LicenceModel(families, vocabulary, frozenset(g for g in known if " " not in g), np.zeros((len(known), len(families))), np.zeros(len(families)))
    data = [(model.active(words_of(p)), k) for p, k in rows]
    order = rng.permutation(len(data))
    held, learn = order[::5], np.setdiff1d(order, order[::5])
    for epoch in range(epochs):
        for i in rng.permutation(learn):
            active, k = data[i]
            grad = model.probabilities(active)
            grad[k] -= 1
            if abs(grad[k]) < 1e-3:
                continue
            step = rate / (1 + 0.2 * epoch)
            model.bias -= 0.1 * step * grad
            if active:
                model.weights[active] -= step * grad / np.sqrt(len(active)) + 1e-5 * model.weights[active]
    # calibration: the temperature that fits lines worded otherwise, and as much again of held-out variants, best
    checks = [(model.active(words_of(p)), place[f]) for p, f in CHECKS]
    checks += [data[i] for i in held[:len(CHECKS)]]
    best = (np.inf, 1.0)
    for t in (0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0):
        model.temperature = t
        loss = -np.mean([np.log(max(model.probabilities(active)[k], 1e-12)) for active, k in checks])
        best = min(best, (loss, t))
    model.temperature = best[1]
    return model


def _pairs(words: list[str]) -> set[tuple[str, str]]:
    return set(zip(words, words[1:], strict=False))


class Templates:
    """The 2-grams of every template, for the comparison."""

    def __init__(self, templates: dict[str, list[str]]):
        self.family, self.size, self.at, self.pairs, self.reach, self.body = [], [], {}, [], [], []
        for family, notices in templates.items():
            for t in notices:
                own = _pairs(words_of(t))
                for pair in own:
                    self.at.setdefault(pair, []).append(len(self.size))
                self.family.append(family)
                self.size.append(len(own))
                self.pairs.append(own)
                self.reach.append(int(SPREAD * len(words_of(t))) + 1)
                self.body.append(t in BODIES.get(family, []))
        self.longest = max(self.reach)

    def alike(self, times: dict[int, int]) -> dict[str, float]:
        """By family, the largest share of a template; ``times``: 2-grams held of each template."""
        best: dict[str, float] = {}
        for t, n in times.items():
            best[self.family[t]] = max(best.get(self.family[t], 0.0), n / self.size[t])
        return best

    def closest(self, words: list[str], family: str) -> tuple[float, int, int]:
        """(similarity, first, last) of the stretch of ``words`` that is most like a template of ``family``.

        A stretch is no longer than the template's reach, so that words scattered over a
        paragraph are no notice, and must name the family unless the template is of a body.
        """
        best = (0.0, 0, 0)
        for t in range(len(self.size)):
            if self.family[t] != family:
                continue
            at = [i for i in range(len(words) - 1) if (words[i], words[i + 1]) in self.pairs[t]]
            inside: dict[tuple[str, str], int] = {}
            low = 0
            for i in at:
                pair = (words[i], words[i + 1])
                inside[pair] = inside.get(pair, 0) + 1
                while i + 2 - at[low] > self.reach[t]:
                    old = (words[at[low]], words[at[low] + 1])
                    inside[old] -= 1
                    if not inside[old]:
                        del inside[old]
                    low += 1
                share = len(inside) / self.size[t]
                if share > best[0] and (self.body[t] or _NAMED[family].search(" ".join(words[max(0, at[low] - 2):i + 2 + AFTER]))):
                    best = (share, at[low], i + 2)
        return best


def _runs(lines: list[tuple[int, int, list[str]]], templates: Templates) -> Iterator[tuple[int, int, dict[str, float]]]:
    """(first, last, similarity by family) of runs of ``lines`` (start, end, words) that hold more of a template than shorter ones do.

    Only runs whose similarity reaches ``CONFIRM``, and of these the families it does so for.
    """
    known, worded = templates.at, [m for m, (_, _, words) in enumerate(lines) if words]
    inside = {m: {p for p in zip(lines[m][2], lines[m][2][1:], strict=False) if p in known} for m in worded}
    joint = {b: {p for p in ((lines[a][2][-1], lines[b][2][0]),) if p in known} for a, b in zip(worded, worded[1:], strict=False)}
    after: dict[int, dict[str, float]] = {}  # similarities of the runs from the next line on, by their last line
    for i in range(len(worded) - 1, -1, -1):
        if not inside[worded[i]] and not (i + 1 < len(worded) and joint[worded[i + 1]]):
            continue  # the runs without this line hold as much
        seen, times, between, best, reached = set(), {}, 0, {}, {}
        for j in range(i, len(worded)):
            if j > i + 1:
                between += len(lines[worded[j - 1]][2])
                if between >= templates.longest:
                    break
            before = best
            new = (inside[worded[j]] | (joint[worded[j]] if j > i else set())) - seen
            if new:
                seen |= new
                for p in new:
                    for t in known[p]:
                        times[t] = times.get(t, 0) + 1
                best = templates.alike(times)
            reached[j], without = best, after.get(j, {}) if j > i else {}
            found = {f: x for f, x in best.items() if x >= CONFIRM and (j == i or x > max(before.get(f, 0), without.get(f, 0)))}
            if found:
                yield worded[i], worded[j], found
        after = reached


def _version(family: str, words: list[str], own: int = 0) -> str | None:
    """The version that a notice of ``own`` words names, or the words behind it up to the next notice; with a + where later ones are allowed."""
    if family in UNVERSIONED:
        return None
    end = next((i for i in range(own, len(words)) if words[i] in ("licensed", "released", "distributed")), len(words))
    text = " ".join(words[:end])
    named = _VERSION.search(text)
    return (named[1] or named[2]) + ("+" if _LATER.search(text) else "") if named else None


def scan_text(text: str | None, model: LicenceModel, templates: Templates) -> tuple[int, list[tuple]]:
    """Number of paragraphs, and (start, end, family, probability, similarity, version) of each licence notice."""
    found, count, at, block = [], 0, 0, []
    for line in [*(text or "").split("\n"), ""]:
        start, at = at, at + len(line) + 1
        words = words_of(line) if line.strip() else []
        marked = SPDX_MARK in words
        if line.strip():
            count += 1
        if line.strip() and not marked:
            block.append((start, start + len(line), words))
            continue
        if block:
            found += _notices(block, model, templates)
            block = []
        if marked:
            found += [(start, start + len(line), *one) for one in _identified(words, model)]
    return count, found


def _identified(words: list[str], model: LicenceModel) -> list[tuple]:
    """(family, probability, similarity, version) of the identifiers behind an SPDX mark; one find a family."""
    out: dict[str, tuple] = {}
    rest = words[words.index(SPDX_MARK) + 1:]
    for before, word in zip(["", *rest], rest, strict=False):
        # what follows "with" is an exception, not a licence
        families = [f for f, ids in SPDX.items() if word in (x.lower() for x in ids)]
        if before == "with" or not families:
            continue
        p = model.probabilities(model.active([SPDX_MARK, word]))
        k = int(p.argmax())
        if p[k] >= SURE and model.families[k] == families[0]:
            out.setdefault(families[0], (families[0], float(p[k]), 1.0, _version(families[0], [word])))
    return list(out.values())


def _notices(lines: list[tuple[int, int, list[str]]], model: LicenceModel, templates: Templates) -> list[tuple]:
    """The licence notices of adjacent ``lines``."""
    likely = []
    for i, j, families in _runs(lines, templates):
        words = [w for line in lines[i:j + 1] for w in line[2]]
        for family in families:
            alike, first, last = templates.closest(words, family)
            if alike < CONFIRM:
                continue
            p = model.probabilities(model.active(words[max(0, first - BEFORE):last + AFTER]))
            k = int(p.argmax())
            if p[k] >= SURE and model.families[k] == family:
                behind = [w for line in lines[j + 1:j + 1 + VERSION_AFTER] for w in line[2]]
                likely.append((-alike, j - i, i, j, family, float(p[k]), _version(family, [*words, *behind][first:last + VERSION_AFTER], last - first)))
    taken: list[tuple] = []
    for one in sorted(likely, key=lambda x: x[:6]):
        if not any(one[2] <= other[3] and other[2] <= one[3] and one[4] == other[4] for other in taken):
            taken.append(one)
    return [(lines[i][0], lines[j][1], family, p, -alike, version) for alike, _, i, j, family, p, version in sorted(taken, key=lambda x: (x[2], x[3], x[4]))]


def train(docs: DataFrame) -> LicenceModel:
    """Ordinary lines come from the ``SAMPLE_DOCS`` documents of smallest id hash, ``SAMPLE_LINES`` of each."""
    lines = F.slice(F.filter(F.split("text", "\n"), lambda x: ~F.lower(x).rlike("licen|copyright|spdx|redistribut|permission")), 1, SAMPLE_LINES)
    picked = docs.select("doc_id").where("doc_id IS NOT NULL").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS)
    got = docs.where("text IS NOT NULL").join(F.broadcast(picked), "doc_id").orderBy("doc_id", "text").limit(SAMPLE_DOCS).select(F.transform(lines, lambda x: F.substring(x, 1, SAMPLE_CHARS)).alias("lines")).collect()  # bounded
    return fit([x for r in got for x in r["lines"] if x])


def scan(docs: DataFrame, model: LicenceModel | None = None) -> DataFrame:
    """doc_id, n_paragraphs and the licence paragraphs (spans, family, probability, similarity) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model or train(docs))

    @F.pandas_udf("n_paragraphs long, licences array<struct<start: long, end: long, family: string, probability: double, similarity: double, version: string>>")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        templates = Templates(TEMPLATES)
        for batch in texts:
            got = [scan_text(t, m, templates) for t in batch]
            yield pd.DataFrame({"n_paragraphs": [n for n, _ in got],
                                "licences": [[dict(zip(("start", "end", "family", "probability", "similarity", "version"), x, strict=True)) for x in found] for _, found in got]})

    return docs.select("doc_id", run(F.col("text").cast("string")).alias("r")).select("doc_id", "r.n_paragraphs", "r.licences")
