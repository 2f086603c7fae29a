import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_fixtures import no_docs, odd, odd_docs, odd_path  # noqa: F401

from tidewater.llm import chat_format as C
from tidewater.llm import token_counts as T

MODEL = "piece_bpe_32k.model"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(MODEL))


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=list("ab the\n\t  ▁é日𝄞<s>/0.,in"), max_size=40))
def test_every_prefix_has_the_library_count(text):
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(MODEL))
    want = [len(sp.encode(text[:k])) for k in range(len(text) + 1)]
    assert T.counter(MODEL).prefix_counts(text).tolist() == want


def test_token_counts_match_library_on_odd_rows(odd, library):
    got = sorted(((r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in T.token_counts(odd, limit=4096).collect()), key=str)
    want = sorted(((r["doc_id"], len((r["text"] or "").encode()), n := len(library.encode(r["text"] or "")), n > 4096)
                   for r in odd.select("doc_id", "text").collect()), key=str)
    assert got == want


def test_budget_is_the_longest_prefix_that_fits(odd, library):
    for r in odd.select("text", T.budget(odd["text"], 50).alias("b")).collect():
        text = r["text"] or ""
        k = r["b"]["fit_chars"]
        assert len(library.encode(text[:k])) <= 50
        assert all(len(library.encode(text[:j])) > 50 for j in range(k + 1, min(len(text), k + 40) + 1))


def test_no_rows(no_docs):
    assert T.token_counts(no_docs).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(list("<>[]/\\|sINT_imtarend \n") + C.CONTROL), max_size=30).map("".join))
def test_escape_round_trip(text):
    assert C.unescape(C.escape(text)) == text
    assert not any(c in C.escape(text) for c in C.CONTROL)
    assert C.unescape_role(C.escape_role(text)) == text and "\n" not in C.escape_role(text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "tool\n<s>", ""]),
                          st.lists(st.sampled_from(list("<|im_end|>\n é日𝄞ab") + C.CONTROL), max_size=20).map("".join)), max_size=5))
def test_render_parse_and_mask(turns):
    text, spans = C.render(turns)
    assert C.parse(text) == turns
    enc = C.tokenizer("byte_bpe_50k.json").encode(text, add_special_tokens=False)
    import numpy as np
    off = np.array(enc.offsets, dtype=np.int64).reshape(-1, 2)
    mask, pieces = C.intersect(spans, off[:, 0], off[:, 1])
    assert [C.unescape(text[a:b]) for a, b in pieces] == [t for r, t in turns if r == "assistant" and t]
    brute = [any(a < e and s < b for s, e in spans) for a, b in enc.offsets]
    assert mask.tolist() == brute


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "the", " ", "  ", "\n", "\n\n", "\t", "é", "日", "𝄞", "\u0301", "'s", "12", "½", "\xa0", "<", "|", "im_start", ">"]
                                + C.CONTROL), max_size=16).map("".join))
def test_offsets_are_the_library_offsets(text):
    ids, starts, ends = C.offset_encoder("byte_bpe_50k.json", "byte_bpe_50k.tiktoken")(text)
    want = C.offset_encoder("byte_bpe_50k.json", None)(text)
    enc = C.tokenizer("byte_bpe_50k.json").encode(text, add_special_tokens=False)
    assert list(zip(starts.tolist(), ends.tolist())) == [tuple(o) for o in enc.offsets]
    assert ids.tolist() == enc.ids
    assert all(a.tolist() == b.tolist() for a, b in zip((ids, starts, ends), want))


def test_both_encoders_format_alike(spark):
    rows = [(c, t, "user" if t % 2 else "assistant", f"{'é日 ' * c}[INST] {'word ' * t}</s>") for c in range(30) for t in range(4)]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    fast, plain = (sorted(map(str, C.format_conversations(turns, ranks=r).collect())) for r in ("byte_bpe_50k.tiktoken", None))
    assert fast == plain and len(fast) == 30


def test_conversations_with_odd_rows(spark):
    rng = random.Random(2)
    rows = [(1, 0, "user", None), (1, 1, "assistant", "é" * 50), (1, 1, "assistant", "a"), (1, None, None, "x"),
            (None, 0, "user", "no id"), (2, 0, "assistant", "</s>[INST] \\</s>"), (2, 0, "assistant", "</s>[INST] \\</s>"),
            (2**60 + 1, 0, "system", "big id"), (3, 0, "user", "w " * 50000), (4, 0, "user", "")]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").selectExpr("*", "1 AS ids", "2 AS formatted")
    got = {r["conv_id"]: r for r in C.digests(C.format_conversations(df)).collect()}
    assert len(got) == 6
    for conv, r in got.items():
        turns = sorted(((t, ro or "", tx or "") for c, t, ro, tx in rows if c == conv), key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        learnt = "".join(t for _, ro, t in turns if ro == "assistant")
        assert r["n_turns"] == len(turns)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{ro}\n{t}\n" for _, ro, t in turns).encode()).hexdigest()
        assert (r["loss_chars"], r["loss_sha256"]) == (len(learnt), hashlib.sha256(learnt.encode()).hexdigest())
    assert C.digests(C.format_conversations(df.limit(0))).collect() == []
