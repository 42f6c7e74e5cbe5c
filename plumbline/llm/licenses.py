"""License scan: MinHash bands over overlapping text windows, verified by exact shingle containment."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm import common
from plumbline.llm.common import mixed, offsets, slices, words_of

#: Words of a shingle, least containment of a template, probability that a window which holds a template shares a band with it.
SHINGLE, CONTAINMENT, SURE = 5, 0.8, 0.9999
#: Share of its own shingles, those that a related template lacks, with which a match stands beside that template's.
OWN = 0.5
#: Notices and permission texts of public licenses, as published.
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
           "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
           "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
           "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
           "substantial portions of the Software.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
                    "conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the "
                    "following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
                    "following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the copyright "
                    "holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior "
                    "written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
                    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
                  "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
                  "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
                  "either express or implied.",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
               "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL-2.0": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
               "by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "LGPL-2.1": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
                "published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "LGPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
                "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "AGPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
                "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
                    "conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the "
                    "following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
                    "following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE "
                    "COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED "
                    "WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
           "above copyright notice and this permission notice appear in all copies.",
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages "
            "arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial "
            "applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
               "file, You can obtain one at",
    "EPL-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or "
                 "distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "BSL-1.0": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation "
               "covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare "
               "derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so",
}


def _notices() -> dict[str, list[str]]:
    """Short notices by license: its names after the words that release under it, its identifier line and its address."""
    version = lambda name, v: [f"{name} {v}", f"{name} version {v}", f"{name} v{v}", f"{name} v {v}"]
    names = {"MIT": ["mit license"], "Apache-2.0": version("apache license", "2.0"), "ISC": ["isc license"], "Unlicense": ["unlicense"], "Zlib": ["zlib license"], "BSL-1.0": version("boost software license", "1.0"),
             "BSD-2-Clause": ["bsd 2-clause license", "2-clause bsd license", "simplified bsd license"], "BSD-3-Clause": ["bsd 3-clause license", "3-clause bsd license", "new bsd license", "modified bsd license"],
             "MPL-2.0": version("mozilla public license", "2.0"), "EPL-2.0": version("eclipse public license", "2.0"), "Artistic-2.0": ["artistic license 2.0"]}
    for gnu, full, versions in (("GPL", "gnu general public license", ("2", "3")), ("LGPL", "gnu lesser general public license", ("2.1", "3")), ("AGPL", "gnu affero general public license", ("3",))):
        for v in versions:
            names[f"{gnu}-{v if '.' in v else v + '.0'}"] = [*version(full, v), *version(full, v + ".0"), f"{gnu.lower()}v{v}", f"gnu {gnu.lower()}v{v}", f"{gnu.lower()}-{v}.0"]
    parts = {"BY": "attribution", "NC": "noncommercial", "SA": "sharealike", "ND": "noderivatives"}
    urls = {"Apache-2.0": ["apache.org/licenses/license-2.0"], "MIT": ["opensource.org/licenses/mit"], "MPL-2.0": ["mozilla.org/mpl/2.0"], "Unlicense": ["unlicense.org"]}
    for kind in ("BY", "BY-SA", "BY-ND", "BY-NC", "BY-NC-SA", "BY-NC-ND"):
        for v in ("2.0", "2.5", "3.0", "4.0"):
            said = "-".join(parts[k] for k in kind.split("-"))
            full = [f"creative commons {said} {v} {x}".strip() for x in ("", "international", "unported", "generic")]
            names[f"CC-{kind}-{v}"] = [f"cc {kind.lower()} {v}", f"cc-{kind.lower()} {v}", f"cc-{kind.lower()}-{v}", *full, *[f"{x} license" for x in full]]
            urls[f"CC-{kind}-{v}"] = [f"creativecommons.org/licenses/{kind.lower()}/{v}"]
    names["CC0-1.0"], urls["CC0-1.0"] = ["cc0 1.0", "cc0 1.0 universal", "cc0-1.0", "creative commons zero"], ["creativecommons.org/publicdomain/zero/1.0"]
    lead = [f"{verb} under {the}".strip() for verb in ("licensed", "released", "distributed", "available", "published") for the in ("", "the", "a", "an", "the terms of the")]
    out = {}
    for license, said in names.items():
        ids = [license, f"{license}-only", f"{license}-or-later"] if "GPL" in license else [license]
        out[f"{license}-notice"] = [f"{a} {b}" for a in lead for b in said] + [f"spdx-license-identifier {i.lower()}" for i in ids] + [f"{h}{u}" for u in urls.get(license, []) for h in ("", "http://", "https://", "http://www.", "https://www.")]
    return out


#: Notices of fewer than ten words, which have to stand word for word.
NOTICES = _notices()
_AROUND = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "\u00a9\u00ab\u00bb\u2013\u2014\u2018\u2019\u201c\u201d\u2022\u2026"


def plain(text: str) -> tuple[list[str], list[int] | None]:
    """The lower-case words of a text without the punctuation around them, and the place of each among all words (none if all are
    left): comment marks and other words of punctuation alone are no words here."""
    all_words = words_of(text.lower())
    words = [w.strip(_AROUND) for w in all_words]
    if "" not in words:
        return words, None
    at = [i for i, w in enumerate(words) if w]
    return [words[i] for i in at], at


def shingles(texts: list[str], k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    return common.shingles([" ".join(plain(t)[0]) for t in texts], k)


def notice_runs(notices: dict[str, list[str]]) -> dict[str, list[tuple[list[str], str]]]:
    """First word -> (words, license)."""
    out: dict[str, list[tuple[list[str], str]]] = {}
    for license, said in notices.items():
        for x in said:
            words = plain(x)[0]
            out.setdefault(words[0], []).append((words, license))
    return out


def noticed(runs: dict[str, list[tuple[list[str], str]]], texts: list[list[str]], covered: dict[int, list[tuple[int, int]]]) -> Iterator[tuple[str, int, int, float, int]]:
    """(license, text, first word, 1.0, times) of the notices that stand in texts of plain words, but for those within the words of a
    longer match (covered: text -> first and end word)."""
    for t, words in enumerate(texts):
        found: dict[str, set[int]] = {}
        for i in [i for i, w in enumerate(words) if w in runs]:
            for said, license in runs[words[i]]:
                if words[i:i + len(said)] == said and not any(lo <= i and i + len(said) <= hi for lo, hi in covered.get(t, ())):
                    found.setdefault(license, set()).add(i)
        for license, places in found.items():
            yield license, t, min(places), 1.0, len(places)


def bands_for(similarity: float, sure: float) -> int:
    """Bands of one row each, of which one agrees with the probability sure at the given Jaccard similarity."""
    return max(1, math.ceil(math.log(1 - sure) / math.log(1 - similarity)))


@dataclass
class Index:
    """Templates by the step of their windows: the smallest power of two that holds their shingles. A window has two steps, windows
    begin at every step, so a run of a template's shingles lies whole in one of them, which then is at most 4 / containment times as
    large as what it shares."""

    names: list[str]
    sets: list[np.ndarray]
    steps: dict[int, list[int]]
    bands: dict[int, int]
    seeds: tuple[np.ndarray, np.ndarray]

    @classmethod
    def build(cls, templates: dict[str, str], containment: float, sure: float) -> Index:
        names = sorted(templates)
        sets = [np.unique(shingles([templates[n]], SHINGLE)[0]) for n in names]
        if any(not len(s) for s in sets):
            raise ValueError("a template needs words")
        steps: dict[int, list[int]] = {}
        for i, s in enumerate(sets):
            steps.setdefault(1 << (len(s) - 1).bit_length(), []).append(i)
        bands = {}
        for step, own in steps.items():
            # the least similarity of a window to a template whose share containment it holds
            least = min(containment * len(sets[i]) / (2 * step + (1 - containment) * len(sets[i])) for i in own)
            bands[step] = bands_for(least, sure)
        x = mixed(np.arange(1, 2 * max(bands.values()) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        half = len(x) // 2
        return cls(names, sets, steps, bands, (x[:half], x[half:] | np.uint64(1)))

    def hashed(self, flat: np.ndarray, band: int) -> np.ndarray:
        a, b = self.seeds
        with np.errstate(over="ignore"):
            return (((flat ^ a[band]) * b[band]) >> np.uint64(32)).astype(np.uint32)


def candidates(index: Index, flat: np.ndarray, counts: np.ndarray) -> dict[int, dict[int, np.ndarray]]:
    """template -> step -> first shingles of the windows that share a band with it. Windows of a text are pairs of neighbouring steps;
    minima of steps are taken from those of half their size."""
    begins = offsets(counts)[:-1]
    found: dict[int, list[np.ndarray]] = {}
    largest = max(index.steps)
    for band in range(max(index.bands.values())):
        low = index.hashed(flat, band)
        n, step = counts.copy(), 1
        while True:
            at = offsets(n)[:-1]
            if step in index.steps and band < index.bands[step]:
                own = index.steps[step]
                wanted = np.array([index.hashed(index.sets[i], band).min() for i in own], np.uint32)
                table = np.zeros(1 << 16, bool)
                table[wanted & 0xFFFF] = True
                # the minimum of a window is that of one of its two steps, so a step that has the value is enough
                hit = np.flatnonzero(table[low & 0xFFFF])
                if len(hit):
                    text = np.searchsorted(at + n, hit, "right")
                    first = begins[text] + (hit - at[text]) * step
                    for value, i in zip(wanted, own):
                        same = low[hit] == value
                        if same.any():
                            found.setdefault(i, []).append(first[same])
            if step >= largest:
                break
            full = n > 0
            half = (n + 1) // 2
            # pairs of steps, an odd last one alone
            cut = np.repeat(at, half) + 2 * (np.arange(int(half.sum())) - np.repeat(offsets(half)[:-1], half))
            low = np.minimum.reduceat(low, cut) if full.any() else low
            n, step = half, step * 2
    return {i: np.unique(np.concatenate(x)) for i, x in found.items()}


def scan(docs: DataFrame, templates: dict[str, str] | None = None, containment: float = CONTAINMENT, sure: float = SURE) -> DataFrame:
    """(doc_id, license, first_word, containment, n_windows) for every document and template that a window of it holds, or notice that
    stands in it word for word (n_windows: how often); notices are looked for unless other templates are given.

    Texts are cut to lower-case words without the punctuation around them, comment marks are no words; windows overlap by half. A window that shares a band with a template is compared exactly: the
    share of the template's shingles that it holds must reach containment. Where related templates match the same words, the shingles
    that tell them apart decide (resolved); a notice inside a longer match is not told beside it. Of several windows the one that holds
    most is told, then the first, with the number of those that reach it. Whole texts are scanned; null and empty texts hold nothing; a text shorter than a
    window is one window; repeated rows are told for each row; a null doc_id stays null. The templates are a short list in the code,
    so each task has all of them.
    """
    runs = notice_runs(NOTICES) if templates is None else {}
    templates = TEMPLATES if templates is None else templates
    index = Index.build(templates, containment, sure)
    parts = (index.names, index.sets, index.steps, index.bands, index.seeds)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = Index(*parts)
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            for first, texts in slices(batch):
                words = [plain(t) for t in texts]
                cleaned = [" ".join(w) for w, _ in words]
                flat, counts = common.shingles(cleaned, SHINGLE)
                told, covered = {}, {}
                for i, t, windows in resolved(ix, flat, offsets(counts), _matches(ix, flat, counts, containment)):
                    told[ix.names[i], t] = _best(windows)
                    covered.setdefault(t, []).extend((place, last + SHINGLE) for _, place, last in windows.values())
                for name, t, *x in noticed(runs, [w for w, _ in words], covered):
                    told.setdefault((name, t), x)
                out = [(ids[first + t].as_py(), name, words[t][1][x[0]] if words[t][1] else x[0], *x[1:]) for (name, t), x in told.items()]
                cols = list(zip(*out)) if out else [()] * 5
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.float64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["doc_id", "license", "first_word", "containment", "n_windows"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(rows, "doc_id long, license string, first_word long, containment double, n_windows long")


Windows = dict[int, tuple[float, int, int]]  # first shingle -> share of the template, first and last place that hold a shingle of it


def _matches(ix: Index, flat: np.ndarray, counts: np.ndarray, containment: float) -> Iterator[tuple[int, int, Windows]]:
    """(template, text, windows) of what holds exactly; first shingles and places are counted from the text's begin."""
    if not len(flat):
        return
    at = offsets(counts)
    step_of = {i: s for s, own in ix.steps.items() for i in own}
    for i, starts in candidates(ix, flat, counts).items():
        step, want = step_of[i], ix.sets[i]
        found: dict[int, Windows] = {}
        text = np.searchsorted(at, starts, "right") - 1
        for t, s in zip(text.tolist(), starts.tolist()):
            # the step with the shared value belongs to two windows
            for lo in (s - step, s):
                if lo < at[t]:
                    continue
                window = flat[lo:min(lo + 2 * step, at[t + 1])]
                share = len(np.intersect1d(window, want)) / len(want)
                if share >= containment - 1e-9:
                    places = int(lo - at[t]) + np.flatnonzero(np.isin(window, want))
                    found.setdefault(t, {})[int(lo - at[t])] = share, int(places[0]), int(places[-1])
        for t, windows in found.items():
            yield i, t, windows


def _best(windows: Windows) -> tuple[int, float, int]:
    """(first word, containment, windows) told of a match."""
    share, place = min((-share, place) for share, place, _ in windows.values())
    return place, -share, len(windows)


def _verified(ix: Index, flat: np.ndarray, counts: np.ndarray, containment: float) -> Iterator[tuple[int, int, int, float, int]]:
    """(template, text, first word, containment, windows) of what holds exactly."""
    for i, t, windows in _matches(ix, flat, counts, containment):
        yield i, t, *_best(windows)


def resolved(ix: Index, flat: np.ndarray, at: np.ndarray, matches: Iterator[tuple[int, int, Windows]]) -> Iterator[tuple[int, int, Windows]]:
    """Matches without the windows that a related template explains better.

    Where windows of two templates share places, each is judged by its own shingles, those that the other lacks. One with at least half
    of its own stands, so two licenses side by side are both told; below that the one with the larger share of its own stands, then
    that with the larger containment, then the first by name. A template without shingles of its own is part of the other and goes.
    """
    by_text: dict[int, dict[int, Windows]] = {}
    for i, t, windows in matches:
        by_text.setdefault(t, {})[i] = windows
    for t, of in by_text.items():
        text = flat[at[t]:at[t + 1]]
        for i, windows in of.items():
            kept = dict(windows)
            for j, others in of.items():
                mine, theirs = np.setdiff1d(ix.sets[i], ix.sets[j]), np.setdiff1d(ix.sets[j], ix.sets[i])
                if i == j or len(mine) == len(ix.sets[i]):
                    continue
                for lo, (share, first, last) in windows.items():
                    for other, begin, end in others.values():
                        if lo not in kept or end < first or last < begin:
                            continue
                        words = text[min(first, begin):max(last, end) + 1]
                        own = len(np.intersect1d(words, mine)) / len(mine) if len(mine) else 0.0
                        its = len(np.intersect1d(words, theirs)) / len(theirs) if len(theirs) else 0.0
                        if own < OWN and (own, share, -i) < (its, other, -j) or not len(mine) and (len(theirs) or i > j):
                            del kept[lo]
            if kept:
                yield i, t, kept
