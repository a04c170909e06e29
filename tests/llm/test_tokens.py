import random

import pytest

from starlot.llm.tokens import Encoder, portions, vocabulary_path

ODD = ["", " ", "a", "a  b", " a b", "a b ", "a\n b", "it's 's", "x  y", "a\tb c", "<|endoftext|> a <|endoftext|>", "\n", "\na b", "é è́ 日本 語", "a\r\n b",
       "\n\nfoo bar", "\n a", "x\n", "\nx\n y", "a b  c", "a \x1cb", "​ ​ x", "😀 👩‍👩‍👧 y"]


@pytest.mark.parametrize("cached", [700_000, 40, 0])
def test_ids_are_the_library_s(cached, small_documents):
    coder = Encoder(vocabulary_path(), cached)
    rnd = random.Random(1)
    mixed = ["".join(rnd.choice(["a", "The", " ", "\n", "é", "9", "'s", ".", "\t", "  ", "ing"]) for _ in range(rnd.randint(0, 40))) for _ in range(600)]
    texts = ODD + mixed + [r.text for r in small_documents.limit(60).collect()]
    for _ in range(2):
        ids, lengths = coder.encode(texts)
        at = 0
        for text, n in zip(texts, lengths):
            assert ids[at:at + n].tolist() == coder.tokenizer.encode(text, add_special_tokens=False).ids, repr(text)
            at += n
        assert at == len(ids)


def test_stretches_of_a_large_vocabulary_are_encoded_once_they_are_known():
    """op2: 250,000 stretches were more than the cache held, so the last of them were encoded each time."""
    coder, asked = Encoder(vocabulary_path()), []
    texts = [" ".join(f"w{i}" for i in range(k, k + 50_000)) for k in range(0, 250_000, 50_000)]
    first = [coder.encode([t])[0].tolist() for t in texts]
    assert [coder.encode([t])[0].tolist() for t in texts] == first
    direct = coder._direct
    coder._direct = lambda x: asked.extend(x) or direct(x)
    assert [coder.encode([t])[0].tolist() for t in texts] == first and not asked


def test_a_vocabulary_that_splits_elsewhere_is_refused():
    coder = Encoder(vocabulary_path())
    coder.opens[:] = False
    with pytest.raises(ValueError, match="other places than blanks"):
        coder.encode(["one two three"])


def test_no_texts_and_portions():
    ids, lengths = Encoder(vocabulary_path()).encode([])
    assert len(ids) == len(lengths) == 0
    texts = ["x" * n for n in (5, 0, 50, 3, 3, 100, 1)]
    assert [t for s in portions(texts, 20) for t in texts[s]] == texts and portions([]) == []
