import re

from starlot.llm import licences


def bigrams(text):
    w = [x for x in re.split(r"[\W_]+", text.lower()) if x]
    return set(zip(w, w[1:]))


def brute(rows, templates):
    out = {}
    for doc_id, text in rows:
        text = text or ""
        segments = {text, *text.split("\n"), *re.split(r"\n[ \t\r\n]*\n", text)} | {s for x in text.split("\n") for s in re.split(r"[.!?]+[ \t]+", x)}
        for s in segments:
            own, best = bigrams(s), {}
            for name, t in templates:
                other = bigrams(t)
                dice = 2 * len(own & other) / (len(own) + len(other)) if own and other else 0
                if dice >= 0.8:
                    best[name] = max(best.get(name, 0), dice)
            for name, dice in best.items():
                top, found = out.get((doc_id, name), (0, set()))
                out[doc_id, name] = (max(top, dice), found | {s})
    return {k: (d, len(s)) for k, (d, s) in out.items()}


def test_against_brute_force(documents):
    mit = licences.TEMPLATES[2][1]
    rows = [
        (1, "Some text. Released under the MIT License. More"), (2, "RELEASED under the mit-license"), (3, "nothing here"), (4, None), (5, ""), (6, "word"),
        (7, mit), (8, "Header\n\n" + mit.replace(", ", ",\n") + "\n\nfooter text"), (9, mit.replace("Software", "Program")), (10, mit[:200]),
        (11, "All rights reserved."), (12, "Licensed under CC BY 4.0\nLicensed under CC BY-NC 4.0"), (13, "all rights are reserved"),
        (14, "This work is licensed under the GNU General Public License, version 2 or 3."), (1, "Some text. Released under the MIT License. More"),
        (None, "All rights reserved. " * 3), (15, "All rights reserved. " * 20_000 + "x"),
    ]
    got = licences.find_licences(documents(rows)).collect()
    assert {(r.doc_id, r.licence): (r.dice, r.n_segments) for r in got} == brute(rows, licences.TEMPLATES)
    assert len(got) == len({(r.doc_id, r.licence) for r in got})


def test_own_templates_and_empty_sides(documents):
    own = [("X", "one two three four"), ("Y", "solo")]
    got = licences.find_licences(documents([(1, "one two three four five"), (2, "solo")]), templates=own).collect()
    assert [(r.doc_id, r.licence) for r in got] == [(1, "X")]
    assert licences.find_licences(documents([])).count() == 0
