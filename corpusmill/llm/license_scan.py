"""License scan: a paragraph classifier over sparse word n-grams, an unknown class, and templates that confirm what it predicts.

Training, on the driver: statements made from the names and wordings below, and paragraphs that speak of other things in like words, become
sets of words and word pairs. For each family, and for licences of no known family, a logistic regression with a lasso penalty weighs them.
Every text stands once among the rows that are learned from or once among those kept back. On the latter, the largest log odds of a family
are calibrated to the probability that it is right (Platt's method), and those of the unknown class to the probability that it is.

A predicted family is confirmed if the paragraph holds at least ``least_alike`` of the word pairs of one of the family's templates (of the
word, where a template is one word). A paragraph whose family is likely and confirmed is of that family; one that is not, but likely of the
unknown class, as reservations of rights and licences of other names are, is of family ``unknown``; any other gives no row.

A paragraph is a line, as texts without blank lines state a licence in one; and a block of lines without blank ones between, as notices are
wrapped: it gives a row for each family that is likely and confirmed in the block but not in one of its lines alone.

Scanning is column expressions only. Anchor words are worked out from the weights such that no line without one can reach a calibrated
threshold, whatever else it says, and from the templates such that no block without one can hold enough of a template that is longer than
a line; lines and blocks without an anchor are passed over and lose nothing.

Rows: null and empty texts have no paragraphs. Texts go in whole. Repeated rows and null ids are scanned each for itself, an empty table
gives an empty result, and only the named columns are read. Equal log odds go to the family first in the alphabet.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import check_names
from .quality import lasso_logistic

#: family -> names it goes by
NAMES = {
    "AGPL": ["GNU Affero General Public License", "GNU Affero General Public License, version 3", "AGPL-3.0", "AGPLv3", "Affero GPL"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache-2.0", "Apache 2.0 license"],
    "BSD": ["BSD License", "BSD-3-Clause", "BSD-2-Clause license", "3-clause BSD license", "simplified BSD license"],
    "CC-BY": ["CC BY 4.0", "Creative Commons Attribution 4.0 International License", "CC-BY-4.0", "Creative Commons Attribution License"],
    "CC-BY-NC": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License", "CC-BY-NC-4.0"],
    "CC-BY-SA": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License", "CC-BY-SA-4.0"],
    "CC0": ["CC0 1.0", "CC0 1.0 Universal Public Domain Dedication", "CC0-1.0"],
    "GPL": ["GNU General Public License", "GNU General Public License, version 3", "GNU General Public License, version 2", "GPL-3.0", "GPLv3", "GNU GPL"],
    "ISC": ["ISC License", "ISC license terms"],
    "LGPL": ["GNU Lesser General Public License", "GNU Lesser General Public License, version 2.1", "LGPL-2.1", "LGPLv3"],
    "MIT": ["MIT License", "MIT license terms", "X11/MIT License"],
    "MPL-2.0": ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL-2.0", "MPL 2.0"],
}
#: family -> sentences from its notice
NOTICES = {
    "AGPL": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation."],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"],
    "BSD": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."],
    "CC-BY": ["This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC": ["This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-SA": ["This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work under CC0."],
    "GPL": ["This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation."],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "LGPL": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation."],
    "MIT": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction.", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
}
#: family -> what follows ``SPDX-License-Identifier:``; those of the GNU family also with -only and -or-later
IDENTIFIERS = {
    "AGPL": ["AGPL-3.0"], "Apache-2.0": ["Apache-2.0"], "BSD": ["BSD-2-Clause", "BSD-3-Clause", "0BSD"], "CC-BY": ["CC-BY-4.0", "CC-BY-3.0"], "CC-BY-NC": ["CC-BY-NC-4.0"], "CC-BY-SA": ["CC-BY-SA-4.0", "CC-BY-SA-3.0"],
    "CC0": ["CC0-1.0"], "GPL": ["GPL-2.0", "GPL-3.0"], "ISC": ["ISC"], "LGPL": ["LGPL-2.1", "LGPL-3.0"], "MIT": ["MIT"], "MPL-2.0": ["MPL-2.0"],
}
#: family -> what is said of things under it
SHORT = {"AGPL": ["AGPL", "AGPLv3"], "Apache-2.0": ["Apache", "Apache 2.0"], "BSD": ["BSD"], "CC-BY": ["CC BY"], "CC-BY-NC": ["CC BY-NC"], "CC-BY-SA": ["CC BY-SA"], "CC0": ["CC0"], "GPL": ["GPL", "GPLv2", "GPLv3"], "ISC": ["ISC"], "LGPL": ["LGPL", "LGPLv3"], "MIT": ["MIT"], "MPL-2.0": ["MPL", "MPL 2.0"]}
#: family -> other wordings of its notice, to learn from; none is a template
WORDINGS = {
    "AGPL": ["You can use and redistribute it under the GNU Affero General Public License, either version 3 or any later version.", "The server code is free software under the AGPL; see COPYING for the GNU Affero General Public License."],
    "Apache-2.0": ["This file is licensed to you under the Apache License, Version 2.0; you may not use it except in compliance with that License.", "Unless required by applicable law, software distributed under the Apache License is distributed on an AS IS basis, without warranties.", "A copy of the License may be obtained at http://www.apache.org/licenses/ or from the foundation.", "See http://www.apache.org/licenses/LICENSE-2.0 for the License."],
    "BSD": ["Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.", "Use in source and binary forms, with or without modification, is permitted if these conditions are met: redistributions in binary form must reproduce the notice.", "Redistribution in source or binary form is permitted provided that these conditions are met:", "Redistribution and use, with or without modification, are permitted provided that the conditions below are met:", "Neither the name of the university nor the names of its contributors may be used to promote derived products without permission.", "Neither the names of the contributors nor of the holder may be used to endorse products derived from this software without prior written permission."],
    "CC-BY": ["The text is available under the Creative Commons Attribution license; you must give appropriate credit.", "Photos are under a Creative Commons Attribution 4.0 licence."],
    "CC-BY-NC": ["Free for use that is not commercial, under the Creative Commons Attribution-NonCommercial license.", "You may share it under Creative Commons Attribution-NonCommercial 4.0 for noncommercial purposes."],
    "CC-BY-SA": ["Content is under the Creative Commons Attribution-ShareAlike license; share alike under the same terms.", "Articles may be reused under Creative Commons Attribution-ShareAlike 3.0."],
    "CC0": ["The author dedicates this work to the public domain under CC0 and waives all rights to it.", "No rights are kept: this work is dedicated to the public domain by a CC0 waiver of copyright and neighboring rights."],
    "GPL": ["It is free software under the GNU General Public License, either version 2 or, at your option, any later version.", "You may redistribute and modify it under the terms of the GNU General Public License as published by the FSF."],
    "ISC": ["Permission to use, copy, modify and distribute this software with or without fee is granted if the copyright notice appears in all copies.", "Permission to use, copy or distribute this for any purpose is hereby granted without fee, provided that this notice appears in all copies.", "Permission to use, copy, modify, and/or distribute this program for any purpose, with or without fee, is granted, provided that this permission notice is kept in all copies.", "Use, copying and distribution of this software for any purpose with or without fee is hereby permitted, provided that the copyright notice appears in every copy.", "The software is provided as is under the ISC license, and the author disclaims all warranties."],
    "LGPL": ["This library is free software under the GNU Lesser General Public License, either version 2.1 or any later version.", "You may link to the library under the terms of the GNU Lesser General Public License."],
    "MIT": ["Any person obtaining a copy of this software is granted permission, free of charge, to use, copy, modify, merge, publish and sell copies of the Software.", "Permission is hereby granted to any person who obtains a copy of the software and associated files to deal in it without restriction.", "Permission is granted free of charge to deal in the Software without restriction, if this permission notice is included in all copies.", "The notice above shall be included in all copies or substantial portions of the Software."],
    "MPL-2.0": ["This source code is subject to the Mozilla Public License, v. 2.0; a copy can be had at mozilla.org/MPL.", "If a copy of the MPL was not distributed with this file, you can obtain one at mozilla.org."],
}
FRAMES = ["Released under the {}.", "Licensed under the {}.", "Licensed under {}.", "This work is licensed under the {}.", "Distributed under the terms of the {}.", "This file is available under {}.", "SPDX-License-Identifier: {}", "License: {}", "The code is covered by the {}; see LICENSE.", "Published under {}", "This project is under the {}."]
SHORT_FRAMES = ["This project is {} licensed.", "{} licensed", "The {} license applies.", "License: {}"]
#: these say that the licence is not given
DENIALS = ["This is not under the {}.", "Not licensed under the {}.", "It is no longer available under {}.", "The code was never released under the {}.", "Nothing here is distributed under the {}."]
#: licences of other names, and rights that are kept
OTHER_NAMES = ["Acme Public License", "Example Software License 1.1", "Community Source License", "Eclipse Public License 2.0", "EPL-2.0", "Zlib license", "Boost Software License", "Artistic License 2.0", "European Union Public Licence", "Unlicense", "custom terms of use", "Business Source License 1.1"]
RESERVED = ["All rights reserved.", "All rights are reserved by the publisher.", "Copyright 2019 by the author. All rights reserved.", "Copyright (c) 2021 Example Ltd. All rights reserved.", "No part of this publication may be reproduced without permission.", "Proprietary and confidential.", "Proprietary software, all rights reserved.", "Unauthorized copying of this file is strictly prohibited.", "May not be redistributed without written permission.", "Licensed under a private agreement between the parties.", "Licensed material, property of the company."]
#: what isn't a licence, in like words
OTHERS = [
    "The driver's license was renewed in May.", "Released under pressure, the statement said little.", "The MIT lecture on algorithms was released on Monday.", "Er kam mit der Familie und mit dem Hund.", "Das Haus mit dem Garten ist mit Blumen geschmückt.",
    "The Apache helicopter landed under fire.", "The general public was not admitted.", "This work is distributed to schools.", "A copy of the software was sold to the museum.", "Version 2.0 of the report is available under the desk.",
    "Permission was granted by the city council.", "The terms of the contract were published.", "Redistribution of income is a matter of debate.", "Licensed physicians may apply here.", "See the file for the source of the data.", "GNU antelopes live in herds on the plains.",
    "The creative commons room is open to all.", "Attribution of the painting is disputed.", "The Mozilla office is in the city.", "Public transport was free of charge.", "Conditions of use are listed at the door.", "The international version appeared in 4.0 million copies.",
    "The commercial license costs more.", "This work is licensed to the library.", "License plates must be visible.", "The berkeley campus is near the bay.", "by nc and sa are abbreviations.", "cc the manager by mail.", "The foundation published free textbooks.", "Clause 3 of the treaty was never met.", "Terms and conditions apply.", "mit freundlichen Grüßen", "She wrote software for the university.", "ISC meeting at noon in room 4.0",
    "The drafting of GPLv3 took two years.", "Readers compared the MIT and BSD licenses in a survey.", "All seats are reserved.", "The rights of the reader were discussed.", "A table was reserved for all guests.", "The copyright office is closed on Mondays.", "Human rights are for all.", "He left without permission.", "The company reserved two rooms.", "A lecture on the history of the GNU General Public License begins at noon.",
]
#: words of any text, of which pairs as in notices are made by chance
COMMON = "a an and as at be between by file for from in is it may no not of on or part permission public software source terms that the this to under used was with without work written".split()
UNKNOWN = "unknown"
WORD = r"[a-z0-9]+(?:[.\-][a-z0-9]+)*"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def grams(text: str) -> set[str]:
    """Words and pairs of neighbours."""
    words = re.findall(WORD, text.translate(str.maketrans(_UPPER, _LOWER)))
    return {*words, *(f"{a} {b}" for a, b in zip(words, words[1:], strict=False))}


def gram_list(text: str) -> list[str]:
    """What a template is compared by: its word pairs, or its word if it is one."""
    found = grams(text)
    return sorted(g for g in found if " " in g) or sorted(found)


def identifiers(family: str) -> list[str]:
    return [i + end for i in IDENTIFIERS[family] for end in (("", "-only", "-or-later") if family in ("AGPL", "GPL", "LGPL") else ("",))]


@lru_cache
def templates(family: str) -> tuple[tuple[str, ...], ...]:
    """The templates of a family as grams. Names of one word that means other things too are not among them by themselves."""
    texts = [*NOTICES[family], *NAMES[family], *(i for i in identifiers(family) if re.search(r"[-\d]", i))]
    texts += [f.format(i) for i in identifiers(family) for f in ("SPDX-License-Identifier: {}", "License: {}")]
    texts += [f.format(x) for x in SHORT[family] for f in ("{} licensed", "{} license", "{} licence")]
    return tuple(dict.fromkeys(tuple(gram_list(t)) for t in texts))


FAMILIES = tuple(sorted(NAMES))


@dataclass(frozen=True)
class LicenseModel:
    #: gram -> its weights, and the intercepts, for each of FAMILIES and then the unknown class
    weights: dict[str, tuple[float, ...]]
    intercepts: tuple[float, ...]
    #: slope and offset of the calibration of families, and of the unknown class
    calibration: tuple[tuple[float, float], tuple[float, float]]

    @property
    def least(self) -> tuple[float, float]:
        """The log odds at which a family, and the unknown class, is as likely right as wrong."""
        return tuple(-offset / slope for slope, offset in self.calibration)

    @cached_property
    def anchors(self) -> tuple[str, ...]:
        return _anchors(self)

    def odds(self, found: set[str]) -> list[float]:
        out = list(self.intercepts)
        for g in sorted(found):
            if (w := self.weights.get(g)) is not None:
                out = [a + b for a, b in zip(out, w, strict=True)]
        return out

    def probability(self, z: float, unknown: bool) -> float:
        slope, offset = self.calibration[unknown]
        return float(1 / (1 + np.exp(-(slope * z + offset))))

    def predict(self, text: str, least_alike: float = 0.5) -> tuple[str | None, float, float]:
        """Family, unknown or None for a paragraph; the calibrated probability, and how alike the family's best template is."""
        found = grams(text)
        *known, other = self.odds(found)
        best = max(range(len(FAMILIES)), key=lambda i: (known[i], -i))
        share = alike(FAMILIES[best], found)
        if known[best] >= self.least[0] and share >= least_alike:
            return FAMILIES[best], self.probability(known[best], False), share
        return (UNKNOWN if other >= self.least[1] else None), self.probability(other, True), 0.0

    def scan(self, text: str | None, least_alike: float = 0.5) -> Iterator[tuple[int, str, float, float, str]]:
        """Paragraph, family, probability, alike and what is said, for each row that ``scan_licenses`` gives for a text; without anchors."""
        lines = (text or "").split("\n")
        said = [self.predict(line, least_alike) for line in lines]
        yield from ((n, *x, lines[n]) for n, x in enumerate(said) if x[0])
        at = 0
        for block in re.split(r"\n[ \t\r]*\n", text or ""):
            size = block.count("\n") + 1
            if size > 1:
                found, shown = grams(block), {x[0] for x in said[at : at + size]}
                for family, z in zip(FAMILIES, self.odds(found), strict=False):
                    if family not in shown and z >= self.least[0] and (share := alike(family, found)) >= least_alike:
                        yield at, family, self.probability(z, False), share, block
            at += size + 1


def alike(family: str, found: set[str]) -> float:
    return max(len(found.intersection(t)) / len(t) for t in templates(family))


def _training() -> list[tuple[str, str | None]]:
    """Texts and what they are: a family, unknown, or None for what is no licence. No text stands twice."""
    out: list[tuple[str, str | None]] = [(f.format(name), family) for family, names in NAMES.items() for name in names for f in FRAMES]
    out += [(f.format(name), family) for family in NAMES for name in identifiers(family) for f in FRAMES[:9]]
    out += [(f.format(name), family) for family, names in SHORT.items() for name in names for f in SHORT_FRAMES]
    out += [(text, family) for family, texts in WORDINGS.items() for text in texts]
    out += [(f"{a} {b}", family) for family, texts in WORDINGS.items() for a in texts for b in ("Copyright 2020 the authors.", "See the file for details.", "All rights reserved.")]
    out += [(f"{n} {f.format(NAMES[family][0])}", family) for family, texts in WORDINGS.items() for n in texts for f in FRAMES[:3]]
    out += [(name, family) for family, names in NAMES.items() for name in names]
    out += [(f.format(name), None) for names in NAMES.values() for name in names for f in DENIALS]
    out += [(text, UNKNOWN) for text in RESERVED] + [(f"{a} {b}", UNKNOWN) for a in RESERVED for b in RESERVED if a != b]
    out += [(f.format(name), UNKNOWN) for name in OTHER_NAMES for f in FRAMES]
    words = sorted({w for o in OTHERS for w in o.split()} | {w for f in FRAMES for w in f.split() if "{" not in w} | {w for r in RESERVED for w in r.split()})
    rng = np.random.default_rng(5)
    out += [(o, None) for o in OTHERS] + [(f"{a} {b}", None) for a, b in (rng.choice(OTHERS, 2, replace=False) for _ in range(120))]
    out += [(" ".join(rng.choice(words, rng.integers(2, 25))), None) for _ in range(600)]
    out += [(" ".join(rng.choice(COMMON, rng.integers(2, 9))), None) for _ in range(900)]
    return list(dict(out).items())


def _fitted(x: np.ndarray, y: np.ndarray, penalty: float, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Intercepts, and weights by class and gram, of a logistic regression for each column of y, by accelerated proximal gradient steps. In
    each the rows of the class weigh as much as a third of all rows; the intercepts aren't penalised."""
    share = y.mean(0)
    rows = np.where(y > 0, np.maximum(1, 1 / (2 * np.maximum(share, 1e-9))), 1.0)
    rows /= rows.sum(0)
    full = np.hstack([np.ones((len(x), 1)), x])
    v = np.ones(full.shape[1])
    for _ in range(30):  # largest eigenvalue
        v = full.T @ (full @ v)
        v /= np.linalg.norm(v)
    step = 4 / (np.linalg.norm(full @ v) ** 2 * rows.max())
    w = ahead = np.zeros((full.shape[1], y.shape[1]))
    t = 1.0
    for _ in range(rounds):
        new = ahead - step * (full.T @ (rows * (1 / (1 + np.exp(-(full @ ahead))) - y)))
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - step * penalty, 0)
        t, last = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        w, ahead = new, new + (last - 1) / t * (new - w)
    return w[0], w[1:].T


@lru_cache
def fit_licenses(penalty: float = 0.0001, rounds: int = 3000) -> LicenseModel:
    rows = _training()
    order = np.random.default_rng(17).permutation(len(rows))
    held, learn = np.sort(order[: len(rows) // 4]), np.sort(order[len(rows) // 4 :])
    sets = [grams(t) for t, _ in rows]
    counts: dict[str, int] = {}
    for i in learn:
        for g in sets[i]:
            counts[g] = counts.get(g, 0) + 1
    vocabulary = sorted(g for g, n in counts.items() if n >= 3)
    at = {g: i for i, g in enumerate(vocabulary)}
    x = np.zeros((len(rows), len(vocabulary)))
    for i, s in enumerate(sets):
        x[i, [at[g] for g in s if g in at]] = 1
    y = np.array([k or "" for _, k in rows])
    intercepts, weights = _fitted(x[learn], np.stack([y[learn] == k for k in (*FAMILIES, UNKNOWN)], 1).astype(float), penalty, rounds)
    weights = np.where(np.abs(weights) > 1e-3, weights, 0.0)
    z = x[held] @ weights.T + intercepts
    known = z[:, :-1]

    def calibrated(odds: np.ndarray, right: np.ndarray) -> tuple[float, float]:
        offset, slope = lasso_logistic(odds[:, None], right.astype(float), 0.0, 2000)
        return float(max(slope[0], 0.05)), float(offset)

    calibration = calibrated(known.max(1), np.array(FAMILIES)[known.argmax(1)] == y[held]), calibrated(z[:, -1], y[held] == UNKNOWN)
    used = np.flatnonzero(np.abs(weights).max(0))
    return LicenseModel({vocabulary[i]: tuple(weights[:, i].tolist()) for i in used}, tuple(intercepts.tolist()), calibration)


def _spread() -> dict[str, int]:
    """How often words occur in texts that are no licences."""
    out: dict[str, int] = {}
    for text in OTHERS:
        for w in re.findall(WORD, text.lower()):
            out[w] = out.get(w, 0) + 1
    return out


def _anchors(model: LicenseModel) -> tuple[str, ...]:
    """Words such that no class reaches its threshold where none of them stands, even with every other gram that speaks for it."""
    least = [model.least[0]] * len(FAMILIES) + [model.least[1]]
    gains = [{g: w[k] for g, w in model.weights.items() if w[k] > 0} for k in range(len(least))]

    def short(words: set[str]) -> bool:
        return all(model.intercepts[k] + sum(v for g, v in gains[k].items() if words.isdisjoint(g.split())) < least[k] for k in range(len(least)))

    spread = _spread()
    chosen = {w for gain in gains for g in gain for w in g.split()}
    if not short(chosen):
        raise ValueError("a class is likely without any word")
    for word in sorted(chosen, key=lambda w: (len(w) > 4, -spread.get(w, 0), len(w), w)):  # words that others use, and short ones, go first
        if short(chosen - {word}):
            chosen.discard(word)
    return tuple(sorted(chosen))


@lru_cache
def block_anchors(least_alike: float) -> tuple[str, ...]:
    """Words of which a text must hold one to be as alike to a template: of each template so many that what is left is too little."""
    spread, out = _spread(), set()
    for family in FAMILIES:
        for template in templates(family):
            for word in sorted({w for g in template for w in g.split()}, key=lambda w: (w not in out, spread.get(w, 0), -len(w), w)):
                if sum(out.isdisjoint(g.split()) for g in template) < least_alike * len(template):
                    break
                out.add(word)
    return tuple(sorted(out))


def _holding(words: tuple[str, ...]) -> str:
    return r"(?i)(?<![a-z0-9])(?:" + "|".join(re.escape(a) for a in sorted(words, key=len, reverse=True)) + r")(?![a-z0-9])"


def _strings(values: Iterator[str] | tuple[str, ...]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _grams(says: Column) -> Column:
    """Distinct words and pairs of neighbours."""
    words = F.regexp_extract_all(F.translate(says, _UPPER, _LOWER), F.lit(f"({WORD})"), 1)

    def both(w: Column) -> Column:
        two = F.zip_with(F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))), F.slice(w, 2, F.size(w)), lambda a, b: F.concat_ws(" ", a, b))
        return F.array_union(w, two)

    return F.transform(F.array(words), both)[0]


def _odds(model: LicenseModel, found: Column) -> Column:
    """The log odds of each class: one look at the weights for each gram that has any."""
    known = F.map_from_arrays(_strings(model.weights), F.array(*[F.array(*[F.lit(v) for v in w]) for w in model.weights.values()]))
    start = F.array(*[F.lit(b) for b in model.intercepts])
    return F.aggregate(F.array_sort(F.array_intersect(found, _strings(model.weights))), start, lambda z, g: F.zip_with(z, F.element_at(known, g), lambda a, b: a + b))


def _alike(family: Column, found: Column) -> Column:
    """Share of the family's best template that is in ``found``."""
    held = F.lit(None).cast("array<array<string>>")
    for name in FAMILIES:
        held = F.when(family == name, F.array(*[_strings(t) for t in templates(name)])).otherwise(held)
    return F.array_max(F.transform(held, lambda t: F.size(F.array_intersect(t, found)) / F.size(t).cast("double")))


def _judged(model: LicenseModel, found: Column, least_alike: float) -> Column:
    """Family, log odds and alike of a paragraph, as ``LicenseModel.predict`` gives them; a null family for what is no licence."""

    def best(z: Column) -> Column:
        top = F.array_max(F.transform(F.slice(z, 1, len(FAMILIES)), lambda v, i: F.struct(v.alias("z"), (-i).alias("first"))))
        other = F.struct(F.when(z[len(FAMILIES)] >= model.least[1], UNKNOWN).alias("family"), z[len(FAMILIES)].alias("z"), F.lit(0.0).alias("alike"))

        def confirmed(t: Column) -> Column:
            family = F.element_at(_strings(FAMILIES), 1 - t["first"])
            share = F.when(t["z"] >= model.least[0], _alike(family, found)).otherwise(0.0)
            of = lambda s: F.when(s >= least_alike, F.struct(family.alias("family"), t["z"].alias("z"), s.alias("alike"))).otherwise(other)
            return F.transform(F.array(share), of)[0]

        return F.transform(F.array(top), confirmed)[0]

    return F.transform(F.array(_odds(model, found)), best)[0]


def _blocks(text: str) -> Column:
    """Runs of lines without blank ones between, with the number of the first line of each."""
    parts = F.split(text, r"\n[ \t\r]*\n")
    empty = F.struct(F.lit(0).alias("next"), F.array().cast("array<struct<paragraph:int,says:string>>").alias("made"))

    def add(state: Column, part: Column) -> Column:
        made = F.concat(state["made"], F.array(F.struct(state["next"].alias("paragraph"), part.alias("says"))))
        return F.struct((state["next"] + F.length(part) - F.length(F.replace(part, F.lit("\n"), F.lit(""))) + 2).alias("next"), made.alias("made"))

    return F.aggregate(parts, empty, add, lambda state: state["made"])


def scan_licenses(df: DataFrame, model: LicenseModel | None = None, *, text: str = "text", keep: tuple[str, ...] = ("doc_id",), least_alike: float = 0.5) -> DataFrame:
    """A row for each line that is a licence, and for each family that a block of lines confirms but none of its lines alone: ``keep``
    columns, paragraph (number of the first line, from 0), family, probability, alike (share of the best template that it holds) and says."""
    model = model or fit_licenses()
    own = tuple(f"__keep{i}" for i in range(len(keep)))
    check_names(keep, ("paragraph", "family", "probability", "alike", "says"))
    line_anchor, block_anchor = _holding(model.anchors), _holding(block_anchors(least_alike))
    whole = df.select(*[F.col(k).alias(o) for k, o in zip(keep, own, strict=True)], F.col(text).cast("string").alias("__text"))

    lines = whole.where(F.col("__text").rlike(line_anchor)).select(*own, F.posexplode_outer(F.split("__text", "\n")).alias("paragraph", "says"))
    lines = lines.where(F.col("says").rlike(line_anchor)).withColumn("__found", _grams(F.col("says")))
    lines = lines.withColumn("__best", _judged(model, F.col("__found"), least_alike)).where("__best.family IS NOT NULL")
    lines = lines.select(*own, "paragraph", "says", "__best.family", "__best.z", "__best.alike")

    blocks = whole.where(F.col("__text").contains("\n") & F.col("__text").rlike(block_anchor)).select(*own, F.explode_outer(_blocks("__text")).alias("b")).select(*own, "b.paragraph", "b.says")
    blocks = blocks.where(F.col("says").contains("\n") & F.col("says").rlike(block_anchor)).withColumn("__found", _grams(F.col("says")))
    blocks = blocks.withColumn("__odds", _odds(model, F.col("__found")))
    likely = F.filter(F.transform(_strings(FAMILIES), lambda k, i: F.struct(k.alias("family"), F.element_at("__odds", i + 1).alias("z"))), lambda o: o["z"] >= model.least[0])
    blocks = blocks.select(*own, "paragraph", "says", "__found", F.explode_outer(likely).alias("__best")).where("__best IS NOT NULL")
    blocks = blocks.withColumn("alike", _alike(F.col("__best.family"), F.col("__found"))).where(F.col("alike") >= least_alike)
    shown = F.exists(F.split("says", "\n"), lambda line: F.coalesce(_judged(model, _grams(line), least_alike)["family"] == F.col("__best.family"), F.lit(False)))
    blocks = blocks.where(~shown).select(*own, "paragraph", "says", "__best.family", "__best.z", "alike")

    (slope, offset), (slope_, offset_) = model.calibration
    chance = 1 / (1 + F.exp(-F.when(F.col("family") == UNKNOWN, F.col("z") * slope_ + offset_).otherwise(F.col("z") * slope + offset)))
    return lines.unionByName(blocks).select(*[F.col(o).alias(k) for k, o in zip(keep, own, strict=True)], "paragraph", "family", chance.alias("probability"), "alike", "says")
