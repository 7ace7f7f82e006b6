"""Idle workers keep few token pieces."""

import pyarrow as pa

from cuadra.llm.packing import cut_pieces
from cuadra.llm.tokens import Encoder, shared_encoder, spaced

WORDS = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in "lmnrst"]


def test_a_worker_keeps_few_pieces_behind_a_task(monkeypatch):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    taken = {}

    class Docs:  # stands for a table; the function that a task would run is called here
        def select(self, *_):
            return self

        def mapInArrow(self, task, _):
            taken["task"] = task

    monkeypatch.setattr("cuadra.llm.packing.F.col", lambda _: type("C", (), {"cast": lambda s, _: s, "alias": lambda s, _: s})())
    cut_pieces(Docs(), path, 0)
    known = shared_encoder(path, spaced).known
    known.trim(0)
    monkeypatch.setattr(type(known).trim, "__defaults__", (50,))
    text = " ".join(f"w{a}{b}" for a in WORDS[:20] for b in WORDS[:20])
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([text, "the end"])], ["doc_id", "text"])
    first = [b.to_pylist() for b in taken["task"](iter([batch]))]
    assert 0 < len(known) + len(known.older) <= 50
    assert [b.to_pylist() for b in taken["task"](iter([batch]))] == first
    assert known[" wbalbal"] == Encoder(path, spaced).encode(" wbalbal")
