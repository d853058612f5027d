"""Notices in long lines, several in one text, wrapped over lines."""

import random

from playlens.llm.license_scan import TEMPLATES, Scanner


def found(text):
    return [(line, k) for line, k, *_ in Scanner(TEMPLATES).scan(text)]


def test_every_template_in_long_lines_of_its_own_words():
    draw = random.Random(2)
    common = sorted({w for t in TEMPLATES.values() for w in t.lower().split()} | {"house", "river", "market", "people"})
    for k, notice in TEMPLATES.items():
        for _ in range(5):
            before, after = ([draw.choice(common[:40]) for _ in range(150)] for _ in range(2))
            text = " ".join([*before, "x", notice, "x", *after])
            assert (0, k) in found(text), k


def test_two_notices_of_a_line_and_wrapped_ones():
    assert found(TEMPLATES["MIT"] + " " + TEMPLATES["Apache-2.0"]) == [(0, "MIT"), (0, "Apache-2.0")]
    assert found("a\nThis work is\nlicensed under the GNU General Public\nLicense, version 3.") == [(1, "GPL-3.0")]
    assert found("All rights reserved. " * 2) == [(0, "all-rights-reserved")] * 2
    # one word missing that also stands before, and a notice without its usual first word
    assert found("the end of it. " + TEMPLATES["CC0-1.0"].replace("under law, the", "under law,")) == [(0, "CC0-1.0")]
    assert found(TEMPLATES["BSD"].replace("Redistribution", "Copying")) == [(0, "BSD")]
    assert found("Licensed under nothing, all rights") == []


def test_every_block_meets_every_template_in_order_of_reduction():
    """Against all windows and all templates, compared word by word."""
    draw = random.Random(7)
    scanner = Scanner({k: TEMPLATES[k] for k in ("MIT", "Apache-2.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "all-rights-reserved")})
    exact = {k: ws for k, ws in scanner.words.items() if len(ws) < 10}  # none of their words may be missing
    pool = sorted({w for ws in exact.values() for w in ws}) + ["house", "river"]
    for _ in range(60):
        ws = [draw.choice(pool) for _ in range(60)]
        for k in draw.sample(sorted(exact), 2):
            at = draw.randrange(len(ws))
            ws[at:at] = exact[k]
        want = {(i, k) for k, t in exact.items() for i in range(len(ws)) if ws[i:i + len(t)] == t}
        blocks = scanner.blocks(ws)
        got = {(a + run[0], k) for a, b in blocks for _, k in scanner.ranked(ws[a:b]) if (run := scanner.confirm(k, ws[a:b]))}
        assert got == want
    for k, ws in scanner.words.items():
        gains = scanner.ranked(ws)
        assert gains[0][1] == k and gains == sorted(gains, key=lambda g: (-g[0], g[1]))
