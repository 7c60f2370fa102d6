import random

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, models

from skyroll.llm import tokens

PATH = public_tokenizers.path("piece_bpe_32k.model")
COUNTER = tokens.Counter(tokens.load_vocabulary(PATH))
MODEL = Tokenizer(models.Unigram(list(tokens.load_vocabulary(PATH).pieces), unk_id=0, byte_fallback=True))


def want(model, text):
    return len(model.encode(tokens.SPACE + text.replace(" ", tokens.SPACE)).ids) if text else 0


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=" \n\tabcdeéñ▁日🙂<0xA>", max_size=40))
def test_as_the_unigram_model(text):
    assert COUNTER.of(text) == want(MODEL, text)


def test_ties_and_unknown_runs():
    rng = random.Random(2)
    for _ in range(60):
        pieces = [("<unk>", 0.0), ("▁", -1.0)] + [(p, float(-rng.randint(1, 3))) for p in {"".join(rng.choices("abc", k=rng.randint(1, 4))) for _ in range(8)}]
        pieces += [("▁" + p, float(-rng.randint(1, 3))) for p, _ in pieces[2:4]]
        model = Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=False))
        counter = tokens.Counter(tokens.Vocabulary(tuple(pieces), False))
        for _ in range(30):
            text = "".join(rng.choices("abcd  ", k=rng.randint(0, 12)))
            assert counter.of(text) == want(model, text), (pieces, text)


def test_odd_rows(documents, odd_rows):
    got = tokens.count_tokens(documents(odd_rows), PATH).collect()
    assert sorted(((r.doc_id, r.n_chars, r.n_tokens) for r in got), key=str) == sorted(((k, len(t or ""), want(MODEL, t or "")) for k, t in odd_rows), key=str)
    assert tokens.count_tokens(documents([]), PATH).count() == 0
