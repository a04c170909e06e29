import random
import zlib

import pytest

from starlot.llm import toxicity


def distance(a, b, beginning=False):
    """Levenshtein distance; with ``beginning``, of ``b`` to the best beginning of ``a``."""
    row = list(range(len(b) + 1))
    best = row[-1]
    for x in a:
        new = [row[0] + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
        best = min(best, row[-1])
    return best if beginning else row[-1]


def test_matcher_against_distances():
    rnd = random.Random(3)
    terms = [("idiot", False, 3.0), ("worthless", False, 4.0), ("pathetic", False, 2.0), ("achlich", True, 5.0), ("abc", False, 1.0), ("patent", True, 2.5), ("loser", False, 3.5)]
    matcher = toxicity.Matcher(terms)
    words = [t for t, _, _ in terms]
    for _ in range(4000):
        w = list(rnd.choice(words) + rnd.choice(["", "", "ung", "x"]))
        for _ in range(rnd.randint(0, 3)):
            at = rnd.randint(0, len(w))
            w[at:at + rnd.randint(0, 1)] = rnd.choice([[], ["a"], ["t"], ["x"]])
        w = "".join(w)
        exact = max([weight for t, b, weight in terms if w == t or b and w.startswith(t)], default=0.0)
        near = max([weight for t, b, weight in terms if 0 < distance(w, t, b) <= toxicity.edits(len(t))], default=0.0)
        assert matcher.weights(w) == (exact, 0.0 if exact else near), w


def test_digits_and_symbols_in_place_of_letters():
    features = toxicity.Features([("idiot", False, 2.0), ("stupid", False, 3.0), ("moron", False, 1.5), ("damn", False, 1.0)])
    plain = lambda t: features.of(t)
    for text, weight in (("id1ot", 2.0), ("st*pid", 3.0), ("m0ron", 1.5), ("M0R0N", 1.5), ("1diot", 2.0), ("$tup!d", 3.0), ("d@mn", 1.0), ("d*mn", 1.0), ("da**", 0)):
        assert plain(f"you {text} here")[3] == weight, text
    assert plain("a 2nd idiot2 of 100km, x*y and mp3")[2:4] == (2.0, 0.0)
    assert plain("3 items cost 40$ or a*b, see v1x2") == (0.0,) * 5
    assert plain("idiot") == plain("IDIOT") != plain("id1ot")


def test_quotation_windows():
    said = lambda t: toxicity.quoted(t, t.index("idiot"), t.index("idiot") + 5)
    assert said('he wrote about "an idiot of a man" there') and said("> idiot") and said("she called him idiot") and said("« un idiot »")
    assert not said('you idiot "really"') and not said("idiot") and not said('"one" idiot "two"')


@pytest.fixture(scope="module")
def scored(spark):
    d = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    return labels, {r.doc_id: r for r in toxicity.op8_toxicity_scores(spark, d).collect()}


def test_held_out_accuracy(scored):
    labels, got = scored
    held = [k for k in labels if got[k].held_out]
    assert all(got[k].held_out == (zlib.crc32(str(k).encode()) % 5 == 0) for k in labels)
    toxic = [k for k in held if labels[k]]
    assert sum(got[k].predicted for k in toxic) >= 0.85 * len(toxic)
    assert sum(got[k].predicted for k in held if not labels[k]) <= 0.02 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id bigint, quality int, toxic int, text int, id int")


def test_misspelled_quoted_and_defined_cases(spark, documents):
    rnd = random.Random(4)
    prose = lambda n: " ".join("".join(rnd.choice("efghijk") for _ in range(rnd.randint(2, 7))) for _ in range(n))
    rows = [(k, prose(40) + (" you are a worthles clwn " if k % 9 == 0 else " you are a worthless clown " if k % 3 == 0 else " ") + prose(20)) for k in range(300)]
    labels = table(spark, [(k, 1, int(k % 3 == 0)) for k in range(300)] + [(3, 1, None), (None, 1, 1), (0, 0, 0)])
    more = [(1001, "what a worthles clwn"), (1002, prose(30)), (1003, None), (1004, ""), (None, "worthless clown"), (1005, prose(30) + ' she said "worthless clown" ' + prose(200)),
            (1006, prose(30) + " a worthless clown " + prose(200)), (1007, prose(90_000) + " worthless"), (1002, "x")]
    got = toxicity.score_documents(documents(rows + more), labels).collect()
    assert len(got) == len(rows) + len(more)
    by = {r.doc_id: r for r in got}
    assert by[1001].predicted == 1 and by[1003].score == by[1004].score < 0.5 and by[1005].score < by[1006].score
    assert by[None].held_out is False and by[None].predicted == 1


def test_without_labels_and_without_documents(spark, documents):
    assert {r.score for r in toxicity.score_documents(documents([(1, "a"), (2, None)]), table(spark, [])).collect()} == {0.0}
    assert toxicity.score_documents(documents([]), table(spark, [(1, 1, 1)])).count() == 0
