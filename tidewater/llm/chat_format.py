"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole, encoded once with character offsets, and the sorted
spans of its assistant texts are intersected with the sorted token spans by binary
search; a token is under the loss mask if it overlaps such a span, and the part of its
text inside the span is what it is trained on.

Template of a turn: ``<|im_start|>ROLE\\nTEXT<|im_end|>\\n``. Control strings inside a role
or text get a backslash after their first character (one more if they have some), so no
text can open or close a turn, and one backslash less gives the text back.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.packing import encoder

START, END = "<|im_start|>", "<|im_end|>"
# Strings that some public chat template or tokenizer reads as control marks.
CONTROL = [START, END, "<|endoftext|>", "<|startoftext|>", "<s>", "</s>", "<unk>", "<pad>", "[INST]", "[/INST]"]
_TAILS = "|".join(re.escape(c[1:]) for c in CONTROL)
_PLAIN = re.compile(rf"([<\[]\\*)({_TAILS})")
_ESCAPED = re.compile(rf"([<\[]\\*)\\({_TAILS})")
_TURN = re.compile(rf"{re.escape(START)}(.*?)\n(.*?){re.escape(END)}\n", re.S)

SCHEMA = ("conv_id bigint, formatted string, ids array<int>, loss_mask array<boolean>, "
          "loss_spans array<struct<start: bigint, end: bigint>>")


def escape(text: str) -> str:
    return _PLAIN.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


def escape_role(role: str) -> str:
    """As a text, and on one line."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role), flags=re.S)


def render(turns: list[tuple[str, str]], loss_roles: tuple[str, ...] = ("assistant",)) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text and the spans, in code points, of the texts to learn."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escape_role(role)}\n", escape(text)
        start = at + len(head)
        if role in loss_roles and body:
            spans.append((start, start + len(body)))
        parts += [head, body, END, "\n"]
        at = start + len(body) + len(END) + 1
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    return [(unescape_role(role), unescape(text)) for role, text in _TURN.findall(formatted)]


def intersect(spans: list[tuple[int, int]], starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Token mask, and the pieces of the spans that masked tokens cover, joined where they touch.

    ``starts`` and ``ends`` are ascending (bytes of one character share its offsets).
    """
    mask = np.zeros(len(starts), dtype=bool)
    pieces: list[tuple[int, int]] = []
    for s, e in spans:
        lo, hi = np.searchsorted(ends, s, side="right"), np.searchsorted(starts, e, side="left")
        if lo >= hi:
            continue
        mask[lo:hi] = True
        a, b = np.maximum(starts[lo:hi], s), np.minimum(ends[lo:hi], e)
        gaps = np.flatnonzero(a[1:] > b[:-1]) + 1
        cuts = [0, *gaps.tolist(), hi - lo]
        pieces += [(int(a[x]), int(b[y - 1])) for x, y in zip(cuts, cuts[1:])]
    return mask, pieces


_TOKENIZERS: dict = {}


def tokenizer(name: str):
    if name not in _TOKENIZERS:
        import public_tokenizers
        from tokenizers import Tokenizer
        _TOKENIZERS[name] = Tokenizer.from_file(public_tokenizers.path(name))
    return _TOKENIZERS[name]


class OffsetEncoder:
    """Ids and offsets, in code points, of a text's tokens.

    With ``ranks``, the byte-level vocabulary of the same model, ids come from its chunks
    (``packing.ChunkEncoder``) and offsets from the tokens' lengths in bytes: the ids of a
    text spell its bytes one after the other, and a token that ends inside a character
    covers all of it. Without ``ranks`` the ``tokenizers`` library gives both.
    """

    def __init__(self, model: str, ranks: str | None):
        self.full = tokenizer(model)
        self.chunks = None if ranks is None else encoder(model, ranks)
        if ranks is not None:
            import public_tokenizers
            self.bytes_of = np.zeros(self.full.get_vocab_size(True), dtype=np.int64)
            with open(public_tokenizers.path(ranks), "rb") as f:
                for token, k in map(bytes.split, f):
                    self.bytes_of[int(k)] = len(base64.b64decode(token))
            for k, added in self.full.get_added_tokens_decoder().items():
                self.bytes_of[k] = len(added.content.encode())

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, starts, ends)"""
        if self.chunks is None:
            enc = self.full.encode(text, add_special_tokens=False)
            offsets = np.array(enc.offsets, dtype=np.int64).reshape(-1, 2)
            return np.array(enc.ids, dtype=np.int32), offsets[:, 0], offsets[:, 1]
        ids = np.frombuffer(self.chunks.ids(text), dtype=self.chunks.dtype).astype(np.int32)
        data = np.frombuffer(text.encode(), dtype=np.uint8)
        char = np.cumsum((data & 0xC0) != 0x80) - 1  # which character a byte is of
        size = self.bytes_of[ids]
        end = np.cumsum(size)
        return ids, char[end - size], char[end - 1] + 1


_ENCODERS: dict[tuple[str, str | None], OffsetEncoder] = {}


def offset_encoder(model: str, ranks: str | None) -> OffsetEncoder:
    if (model, ranks) not in _ENCODERS:
        _ENCODERS[model, ranks] = OffsetEncoder(model, ranks)
    return _ENCODERS[model, ranks]


_CHARS = 500_000  # formatted, that go back to Spark together


def format_conversations(turns: DataFrame, loss_roles: tuple[str, ...] = ("assistant",), model: str = "byte_bpe_50k.json",
                         ranks: str | None = "byte_bpe_50k.tiktoken") -> DataFrame:
    """One row per conversation: formatted text, token ids, loss mask per token, learned character spans.

    Turns go by (turn, role, text), NULL first, so ties have one order and repeated rows
    are turns of their own. NULL roles and texts are empty; rows with NULL conv_id make up
    one conversation with that id. Only conv_id, turn, role and text are read; an empty
    table gives no rows. A conversation is one text and so must fit one task, like any text.
    ``ranks``: the vocabulary of ``model`` by bytes, or None to encode by the ``tokenizers`` library alone.
    """
    rows = (turns.groupBy("conv_id")
            .agg(F.sort_array(F.collect_list(F.struct(
                "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
            )).alias("turns"))
            .withColumn("conv_id", F.col("conv_id").cast("string")))  # pandas would turn ids beside a NULL into floats

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, names = offset_encoder(model, ranks), ["conv_id", "formatted", "ids", "loss_mask", "loss_spans"]
        held, size = [], 0

        def frame() -> pd.DataFrame:
            out = pd.DataFrame(held, columns=names)
            return out.assign(conv_id=pd.array([None if c is None else int(c) for c in out["conv_id"]], dtype="Int64"))
        for batch in batches:
            for conv_id, ts in zip(batch["conv_id"], batch["turns"]):
                text, spans = render([(t["role"], t["text"]) for t in ts], loss_roles)
                ids, starts, ends = encode(text)
                mask, pieces = intersect(spans, starts, ends)
                held.append((conv_id, text, ids, mask, [{"start": a, "end": b} for a, b in pieces]))
                size += len(text)
                if size >= _CHARS:
                    yield frame()
                    held, size = [], 0
        if held:
            yield frame()
    return rows.mapInPandas(run, SCHEMA)


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation, read back from its formatted text and loss spans: turns, hashes and lengths."""
    @F.pandas_udf("struct<n_turns: bigint, turns_sha256: string, loss_chars: bigint, loss_sha256: string>")
    def read_back(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
        out = []
        for text, ss in zip(texts, spans):
            turns = parse(text)
            said = "".join(f"{r}\n{t}\n" for r, t in turns)
            learnt = "".join(unescape(text[s["start"]:s["end"]]) for s in ss)
            out.append((len(turns), hashlib.sha256(said.encode()).hexdigest(), len(learnt),
                        hashlib.sha256(learnt.encode()).hexdigest()))
        return pd.DataFrame(out, columns=["n_turns", "turns_sha256", "loss_chars", "loss_sha256"])
    return (formatted.select("conv_id", F.char_length("formatted").cast("bigint").alias("formatted_chars"),
                             read_back("formatted", "loss_spans").alias("d"))
            .select("conv_id", "d.*", "formatted_chars"))


def oracle(table: str = "conversations") -> str:
    """DuckDB SQL for ``digests`` of ``table`` and the extra conversation of the query."""
    tails = "|".join(re.escape(c[1:]).replace("'", "''") for c in CONTROL)
    control = rf"([<\[]\\*)({tails})"
    esc = lambda x: rf"regexp_replace({x}, '{control}', '\1\\\2', 'g')"
    role = r"replace(replace(role, '\', '\\'), chr(10), '\n')"
    fixed = len(START) + 1 + len(END) + 1
    order = "ORDER BY turn NULLS FIRST, role, text"
    return f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM {table}
           UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' {order})) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' {order}) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum({fixed} + length({esc(role)}) + length({esc('text')}))::BIGINT AS formatted_chars
FROM c GROUP BY conv_id"""
