import pyarrow as pa

from ferrolake.llm import common


def test_texts_become_objects_a_piece_at_a_time(monkeypatch):
    taken = []
    real = common.binary
    monkeypatch.setattr(common, "binary", lambda col: taken.append(len(col)) or real(col))
    texts = ["a" * 40, None, "é" * 30, "", "b" * 500, "c"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(texts)], names=["id", "text"])
    got = [(i, t) for part, piece in common.text_pieces([batch, batch.slice(0, 0), batch.slice(2)], 100)
           for i, t in zip(part.column(0).to_pylist(), piece)]
    want = [(i, t.encode() if t is not None else None) for i, t in enumerate(texts)]
    assert got == want + want[2:]
    assert len(taken) > 2 and max(taken) < len(batch)


def test_a_task_gives_its_memory_back_at_its_end(monkeypatch):
    given = []
    monkeypatch.setattr(common, "give_back", lambda: given.append(1))
    rows = common.tidy(iter([1, 2]))
    assert next(rows) == 1 and not given
    assert list(rows) == [2] and given == [1]
