"""What stays in a Python worker between tasks is small: several stages share the workers."""

import pyarrow as pa

from chronodim.llm import common, simhash_golay, tokens


def test_batches_are_cut_before_they_become_objects():
    got = []

    def run(batches):
        for b in batches:
            got.append(b.num_rows)
            yield b

    rows = pa.RecordBatch.from_arrays([pa.array(range(2 * common.BATCH_ROWS + 5))], ["x"])
    out = list(common.in_batches(run)(iter([rows, rows.slice(0, 0)])))
    assert got == [common.BATCH_ROWS, common.BATCH_ROWS, 5]
    assert pa.Table.from_batches(out).equals(pa.Table.from_batches([rows]))


def test_kept_runs_and_bits_are_bounded():
    assert 2 * tokens.CACHE_RUNS <= 500_000
    assert simhash_golay.BLOCK_SHINGLES * 64 * 8 <= 32 << 20       # bits as 64-bit sums


def test_fingerprints_do_not_depend_on_blocks(monkeypatch):
    texts = [" ".join(f"w{(i * j) % 37}" for j in range(i % 90)) for i in range(300)] + [None, "", "one"]
    whole = simhash_golay.fingerprints(texts)
    monkeypatch.setattr(simhash_golay, "BLOCK_SHINGLES", 7)
    assert (simhash_golay.fingerprints(texts) == whole).all()
