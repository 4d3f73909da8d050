import hashlib
import random

import numpy as np
from llm_frames import LINE, awkward, documents, nothing

from wattline.llm import lines
from wattline.llm.perfect_hash import PerfectHash

SPACES = " \t\n\x0b\x0c\r"


def plain(rows, min_docs=5):
    """Text and dropped lines of each row, by looking at all lines."""
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACES))
    holders = {}
    for n, (i, text) in enumerate(rows):
        for k in {key(x) for x in (text or "").split("\n")}:
            holders.setdefault(k, []).append((n, i))
    out = []
    for i, text in rows:
        kept, parts = [], (text or "").split("\n")
        for x in parts:
            all_ = holders[key(x)]
            ids = [d for _, d in all_ if d is not None]
            gone = len(key(x)) >= 40 and len(all_) >= min_docs and ids and i != max(ids)
            kept += [] if gone else [x]
        out.append((i, len(parts), len(parts) - len(kept), "\n".join(kept)))
    return out


def found(docs, **options):
    out = lines.dedup_lines(docs, **options)
    return [(r.row.doc_id, r.n_lines, r.n_dropped, r.kept) for r in out.collect()]


def by_id(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r))


def test_equals_plain_way_in_arrays_and_by_sending(spark, monkeypatch):
    draw = random.Random(1)
    shared = [f"shared line number {k} that is certainly long enough" for k in range(30)]
    rows = []
    for i in range(200):
        mine = [draw.choice(shared) for _ in range(draw.randint(0, 6))] + [f"own line {i} {k} " * 3 for k in range(3)] + ["short"]
        draw.shuffle(mine)
        rows.append((i, "\n".join(x.upper() if draw.random() < 0.2 else f" {x}\t" for x in mine)))
    docs, wanted = documents(spark, [(i, t, "a") for i, t in rows]), by_id(plain(rows))
    assert by_id(found(docs)) == wanted
    assert by_id(found(docs, shard_keys=7)) == wanted
    monkeypatch.setattr(lines, "PORTION_LINES", 50)
    assert by_id(found(docs, broadcast_bytes=0, shard_keys=7)) == wanted


def test_awkward_rows(spark):
    docs = awkward(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    for size in (1 << 20, 0):
        assert by_id(found(docs, min_docs=3, broadcast_bytes=size)) == by_id(plain(rows, 3))
    assert lines.dedup_lines(nothing(spark)).count() == 0
    assert lines.dedup_lines(nothing(spark), broadcast_bytes=-1).count() == 0


def test_documents_without_id_keep_their_lines(spark):
    docs = documents(spark, [(None, LINE, "a")] * 6)
    assert [r[3] for r in found(docs)] == [LINE] * 6


def test_perfect_hash_is_minimal_and_tells_strangers():
    keys = [hashlib.md5(str(i).encode()).digest() for i in range(5000)]
    halves = np.frombuffer(b"".join(keys), np.uint64).reshape(-1, 2)
    table = PerfectHash.build(halves[:, 0], halves[:, 1])
    places = table.places(halves[:, 0], halves[:, 1])
    assert sorted(places.tolist()) == list(range(5000))
    assert len(table.words) * 64 + len(table.ranks) * 32 < 8 * 5000
    prints = np.empty(5000, np.uint64)
    prints[places] = halves[:, 0]
    strange = halves[:, ::-1].copy()
    at = table.places(strange[:, 0], strange[:, 1])
    assert not ((at >= 0) & (prints[at] == strange[:, 0])).any()
    none = PerfectHash.build(halves[:0, 0], halves[:0, 1])
    assert none.places(strange[:3, 0], strange[:3, 1]).tolist() == [-1, -1, -1]
