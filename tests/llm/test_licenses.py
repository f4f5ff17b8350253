"""License notices inside sentences, short grants and tags; all windows of all templates by brute force."""

import random

import pytest

from vendora.llm import licenses

PROSE = "we walked along the river and talked about nothing in particular while the others waited for the boat to come back"


@pytest.fixture(scope="module")
def scanner():
    return licenses.Scanner()


def test_notices_inside_sentences(scanner):
    cases = {
        "The code is released under the MIT License, see below, and documentation under CC BY 4.0.": ["MIT", "CC-BY-4.0"],
        "This project is available under the MIT license": ["MIT"],
        "Licensed under the GNU GPL v2": ["GPL-2.0"],
        "SPDX-License-Identifier: MIT": ["MIT"],
        f"{PROSE} {PROSE} and it is licensed under the Apache License, Version 2.0": ["Apache-2.0"],
        "// SPDX-License-Identifier: GPL-3.0-or-later and more text on one line without an end": ["GPL-3.0"],
        "Licensed under CC BY-ND 4.0.": [],
        "This license of the driver was not under discussion when the mit students came": [],
        "ÉTÉ: parts are Available  under\nthe MIT LICENSE, others not": ["MIT"],
        "It is not released under the MIT License.": ["MIT"],  # what the wording says, not what the sentence means
    }
    for text, want in cases.items():
        got = scanner.scan(text)
        assert [x[2] for x in got] == want, text
        assert all(0 <= s < e <= len(text) for s, e, *_ in got)
    text = "ÉTÉ: parts are Available  under\nthe MIT LICENSE, others not"
    s, e, *_ = scanner.scan(text)[0]
    assert text[s:e] == "Available  under\nthe MIT LICENSE"


def test_all_windows_by_brute_force(scanner):
    """Notices with a word changed, lost or put in, anywhere in prose: what trying every window of every template's word count finds is found."""
    rng = random.Random(11)
    prose = PROSE.split()
    for name, wording, _ in rng.sample(licenses.TEMPLATES, 30):
        w = wording.split()
        if len(w) > 8:
            k = rng.randrange(1, len(w) - 1)
            w[k : k + 1] = rng.choice(([], ["thing"], [w[k], "indeed"]))
        text = " ".join([*rng.choices(prose, k=rng.randrange(12)), *w, *rng.choices(prose, k=rng.randrange(12))])
        if not licenses._cue.search(text):
            continue
        found = [(m.start(), m.end()) for m in licenses._any_word.finditer(text)]
        every = []  # also windows of other templates' word counts, which may fit a changed wording a little better
        for n in {len(want) for _, want, _ in scanner.templates}:
            for i in range(len(found) - n + 1):
                s, e = found[i][0], found[i + n - 1][1]
                if x := scanner.judge(text[s:e]):
                    every.append((x[2], s, e, x[0]))
        got = scanner.scan(text)
        assert bool(every) == bool(got), (name, text)
        if every:
            share, start, end, license_ = max(every)
            hit = max((x for x in got if x[0] < end and start < x[1]), key=lambda x: x[4])
            assert hit[2] in (name, license_) and hit[4] >= share - 0.05, (text, got)
