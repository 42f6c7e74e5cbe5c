import random

import numpy as np
import pytest

from plumbline.llm import licenses


def shingle_set(words):
    w = [x.lower() for x in words]
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def test_planted_templates_are_found_where_they_stand(spark):
    rng = random.Random(2)
    fill = lambda n: ["f%d" % rng.randint(0, 10**6) for _ in range(n)]
    rows, want = [], {}
    for i in range(60):
        name = rng.choice(sorted(licenses.TEMPLATES))
        lead = fill(rng.randint(0, 90))
        rows.append((i, " ".join([*lead, *licenses.TEMPLATES[name].split(), *fill(rng.randint(0, 50))]), "clash"))
        want[i] = (name, len(lead))
    rows += [(100, None, None), (101, "", None), (102, " ".join(fill(30000)), None), (None, licenses.TEMPLATES["MIT-notice"], None), rows[0]]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string, license string").repartition(3)).collect()
    for i, (name, place) in want.items():
        mine = [r for r in got if r.doc_id == i and r.license == name]
        assert mine and all((r.first_word, r.containment) == (place, 1.0) for r in mine), (i, name)
    assert len([r for r in got if r.doc_id == 0 and r.license == want[0][0]]) == 2
    assert not {100, 101, 102} & {r.doc_id for r in got} and [r.license for r in got if r.doc_id is None] == ["MIT-notice"]


@pytest.mark.parametrize("seed", range(3))
def test_containment_equals_brute_force(seed):
    """Edited templates: every window of the operator's grid is compared with every template."""
    rng = random.Random(seed)
    index = licenses.Index.build(licenses.TEMPLATES, 0.8, 0.9999)
    texts = []
    for _ in range(40):
        w = licenses.TEMPLATES[rng.choice(sorted(licenses.TEMPLATES))].split()
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = "edit%d" % rng.randint(0, 999)
        texts.append(" ".join(["lead%d" % rng.randint(0, 999) for _ in range(rng.randint(0, 20))] + w))
    flat, counts = licenses.shingles(texts, 5)
    got = {(i, t): (place, share) for i, t, place, share, _ in licenses._verified(index, flat, counts, 0.8)}
    at = licenses.offsets(counts)
    want = {}
    for step, own in index.steps.items():
        for i in own:
            for t in range(len(texts)):
                for lo in range(at[t], at[t + 1], step):
                    window = flat[lo:min(lo + 2 * step, at[t + 1])]
                    share = len(np.intersect1d(window, index.sets[i])) / len(index.sets[i])
                    if share >= 0.8:
                        place = int(lo - at[t]) + int(np.flatnonzero(np.isin(window, index.sets[i]))[0])
                        if (i, t) not in want or (-share, place) < (-want[i, t][1], want[i, t][0]):
                            want[i, t] = (place, share)
    assert got == want


def test_bands_guarantee_their_probability():
    for s in (0.15, 0.25, 0.5):
        assert 1 - (1 - s) ** licenses.bands_for(s, 0.9999) >= 0.9999


def test_no_documents(no_docs):
    assert licenses.scan(no_docs).collect() == []


def test_notices_without_their_marks_and_licenses_in_comments(spark):
    said = {
        "Licensed under the Apache License, Version 2.0": "Apache-2.0-notice", "(released under the MIT License,)": "MIT-notice", "# SPDX-License-Identifier: LGPL-2.1-or-later": "LGPL-2.1-notice",
        "Licensed under CC BY-SA 3.0.": "CC-BY-SA-3.0-notice", "see https://creativecommons.org/licenses/by-nc-nd/4.0/ there": "CC-BY-NC-ND-4.0-notice", "Released under the ISC license": "ISC-notice",
    }
    rows = [(i, "one two -- three " + t + " four") for i, t in enumerate(said)]
    long = sorted(n for n in licenses.TEMPLATES if len(licenses.TEMPLATES[n].split()) > 15)
    for k, n in enumerate(long):
        w = licenses.TEMPLATES[n].split()
        mark = ("#", "*", "//")[k % 3]
        rows.append((100 + k, "/* x\n" + "".join(f" {mark} " + " ".join(w[i:i + 7]) + "\n" for i in range(0, len(w), 7))))
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    of = {(r.doc_id, r.license): r for r in got}
    assert all((i, n) in of for i, n in enumerate(said.values())), got
    assert all((100 + k, n) in of and of[100 + k, n].first_word == 3 for k, n in enumerate(long)), got
    assert of[0, "Apache-2.0-notice"].first_word == 4


def test_each_text_gives_exactly_its_own_licenses(spark):
    rng = random.Random(8)
    fill = lambda n: " ".join("f%d" % rng.randint(0, 10**6) for _ in range(n))
    rows, want = [], {}

    def add(text, *names):
        want[len(rows)] = sorted(names)
        rows.append((len(rows), text))

    for name, said in licenses.TEMPLATES.items():
        w = said.split()
        add(said, name)
        add(f"{fill(37)} {said} {fill(300)}", name)
        for mark in ("#", "*", "//"):
            add("/*\n" + "".join(f" {mark} " + " ".join(w[i:i + 7]) + "\n" for i in range(0, len(w), 7)) + " */ " + fill(9), name)
        if len(w) > 60:  # a word that no template tells apart by
            add(" ".join([*w[:3], "edited", *w[4:]]), name)
    numbered = licenses.TEMPLATES["BSD-3-Clause"].replace("met: Redis", "met: 1. Redis").replace("disclaimer. Redis", "disclaimer. 2. Redis").replace("tion. Neither", "tion. 3. Neither")
    add(numbered, "BSD-3-Clause")
    add(numbered.replace(numbered[numbered.index("3. Neither"):numbered.index("THIS SOFT")], ""), "BSD-2-Clause")
    for pair in (("GPL-3.0", "LGPL-3.0"), ("GPL-2.0", "GPL-3.0"), ("AGPL-3.0", "GPL-3.0"), ("LGPL-2.1", "LGPL-3.0"), ("BSD-2-Clause", "BSD-3-Clause"), ("Apache-2.0", "MIT")):
        for gap in (0, 5, 400):
            add(f"{licenses.TEMPLATES[pair[0]]} {fill(gap)} {licenses.TEMPLATES[pair[1]]}", *pair)
    add(licenses.TEMPLATES["Apache-2.0"] + " " + fill(500) + " Licensed under the Apache License, Version 2.0.", "Apache-2.0", "Apache-2.0-notice")
    got = {i: [] for i in want}
    for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect():
        got[r.doc_id].append(r.license)
    assert {i: (rows[i][1][:60], sorted(g), want[i]) for i, g in got.items() if sorted(g) != want[i]} == {}
