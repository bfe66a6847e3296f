"""Memory of tasks beside the JVM."""

import subprocess
import sys
import tracemalloc
from pathlib import Path

import numpy as np
import pyarrow as pa

import corpus_pipeline
from basketry.llm import packing, suffixes, tokens


def random_batch(texts: int, size: int) -> pa.RecordBatch:
    letters = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz     ", np.uint8)
    drawn = np.random.default_rng(7).choice(letters, (texts, size))
    return pa.record_batch(
        [pa.array(range(texts), pa.int64()), pa.array([row.tobytes().decode() for row in drawn])],
        names=["doc_id", "text"],
    )


def test_segments_are_dealt_in_little_memory():
    batch = random_batch(3_000, 2_000)
    tracemalloc.start()
    held = tracemalloc.get_traced_memory()[0]
    keys = sum(
        len(row) // 4
        for out in suffixes._dealt(suffixes.LENGTH, 8)(iter([batch]))
        for row in out.column("keys").to_pylist()
    )
    peak = tracemalloc.get_traced_memory()[1] - held
    tracemalloc.stop()
    assert keys > 250_000  # more than are held at once
    assert peak < 45e6


KEPT = """
import re
from pathlib import Path
import numpy as np
import pyarrow as pa
from basketry.llm import packing, tokens

def megabytes():
    held = Path("/proc/self/smaps_rollup").read_text()
    return sum(map(int, re.findall(r"\\nPss_(?:Anon|Shmem):\\s+(\\d+)", held))) / 1024

def batches():
    letters = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz    ", np.uint8)
    for k in range(12):
        drawn = np.random.default_rng(k).choice(letters, (1_000, 2_000))
        texts = [row.tobytes().decode() for row in drawn]
        yield pa.record_batch([pa.array(range(1_000), pa.int64()), pa.array(texts)], names=["doc_id", "text"])

before = megabytes()
rows = sum(b.num_rows for b in packing._pieces(tokens.default_path(), 1024, 2, False)(batches()))
print(rows, megabytes() - before)
"""


def test_a_worker_gives_back_what_packing_has_used():
    folder = Path(__file__).resolve().parents[2]
    done = subprocess.run(
        [sys.executable, "-c", KEPT], cwd=folder, capture_output=True, text=True, timeout=300, check=True
    )
    rows, kept = done.stdout.split()
    assert int(rows) >= 12_000
    assert float(kept) < 190


def test_the_pipeline_packs_with_a_smaller_memory(monkeypatch):
    asked = {}
    monkeypatch.setattr(packing, "pack", lambda docs, path, **options: asked.update(options))
    corpus_pipeline.packed_sequences(None, None, "")
    assert asked["remembered"] < tokens.REMEMBERED
    encoder = tokens.Encoder(tokens.default_path(), remembered=1_000)
    encoder.known.clear()
    words = [f"w{k}" for k in range(30_000)]
    for at in range(0, len(words), 500):
        encoder.encode([" ".join(words[at : at + 500])])
        assert len(encoder.known) <= 3_000
