import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from qrank.llm import packing, records
from qrank.llm.catalog import tokenizer_file
from qrank.llm.tokens import Encoder

from . import data


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(tokenizer_file())


def ids_of(tok, text, end):
    return np.append(tok.encode(text or "", add_special_tokens=False).ids, end).astype("<u4")


def test_encoder_is_the_librarys(tok):
    import random
    rng = random.Random(2)
    some = ["a", "the", "é", "ß", " ", "\n", "'s", "'", "!", "12", " The", "<|endoftext|>", "\t", "中", "I'll", "²", "_", " "]
    texts = ["".join(rng.choice(some) for _ in range(rng.randint(0, 14))) for _ in range(4000)] + [r[1] or "" for r in data.rows()]
    got = Encoder(tokenizer_file()).encode(texts)
    want = [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == want
    special = np.frombuffer(Encoder(tokenizer_file()).encode(["<|endoftext|> text"])[0], "<u4")
    assert special.tolist() == [50256, 2420]


def test_records_round_trip(spark, tok, tmp_path):
    docs = data.documents(spark)
    records.write_records(docs, f"{tmp_path}/d", tokenizer_file(), 0, file_bytes=20_000)
    index = records.build_index(spark, f"{tmp_path}/d", f"{tmp_path}/i")
    got = records.with_starts(index).orderBy("start").collect()
    want = sorted(data.rows(), key=lambda r: (r[0] is not None, r[0] or 0))
    assert [g.doc_id for g in got] == [w[0] for w in want]
    assert index.select("part").distinct().count() > 3
    at, by_id = 0, {}
    for g in got:
        assert g.start == at
        at += g.n_tokens
        by_id.setdefault(g.doc_id, []).append((g.n_tokens, g.ids_crc32))
    for i in by_id:
        mine = [ids_of(tok, r[1], 0) for r in data.rows() if r[0] == i]
        assert Counter(by_id[i]) == Counter((len(x), zlib.crc32(x.tobytes())) for x in mine)


def test_index_gives_random_access_and_damage_is_seen(spark, tok, tmp_path):
    import glob
    import re
    records.write_records(data.documents(spark), f"{tmp_path}/d", tokenizer_file(), 0, file_bytes=50_000)
    files = {int(re.search(r"part-(\d+)", f)[1]): open(f, "rb").read() for f in glob.glob(f"{tmp_path}/d/part-*")}
    for r in records.scan_records(spark, f"{tmp_path}/d").collect()[::7]:
        doc_id, ids = records.read_at(files[r.part], r.byte_offset)
        assert doc_id == r.doc_id and len(ids) == r.n_tokens and ids[-1] == 0
    one = next(x for x in files.values() if len(x) > 60)
    for at in (0, 9, 30):
        with pytest.raises(ValueError):
            list(records.frames(one[:at] + bytes([one[at] ^ 1]) + one[at + 1:]))
    with pytest.raises(ValueError):
        list(records.frames(one[:-3]))


def test_empty_tables(spark, tmp_path):
    records.write_records(data.empty(spark), f"{tmp_path}/d", tokenizer_file(), 0)
    assert records.with_starts(records.build_index(spark, f"{tmp_path}/d", f"{tmp_path}/i")).count() == 0
    assert packing.pack_documents(data.empty(spark), tokenizer_file(), 1).count() == 0


def test_packing_places_every_id_once(spark, tok):
    got = packing.pack_documents(data.documents(spark), tokenizer_file(), 1, group_docs=20).collect()
    full = [(r[0], ids_of(tok, r[1], 1)) for r in data.rows()]
    want = Counter((i, k, min(2048, len(x) - k), zlib.crc32(x[k:k + 2048].tobytes()), len(x))
                   for i, x in full for k in range(0, len(x), 2048))
    assert Counter((g.doc_id, g.start, g.length, g.ids_crc32, g.doc_tokens) for g in got) == want
    by = {}
    for g in got:
        by.setdefault(g.sequence_id, []).append((g.offset, g.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048


def test_tournament_is_first_fit():
    import random
    rng = random.Random(4)
    sizes = [rng.randint(1, 100) for _ in range(400)]
    got = packing.first_fit_decreasing(sizes, 100)
    bins, want = [], {}
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        b = next((b for b, used in enumerate(bins) if used + sizes[i] <= 100), len(bins))
        if b == len(bins):
            bins.append(0)
        want[i] = (b, bins[b])
        bins[b] += sizes[i]
    assert got == [want[i] for i in range(len(sizes))]


def test_sequences_hold_the_ids(spark, tok):
    docs = data.documents(spark).where("doc_id < 12 and text is not null").dropDuplicates(["doc_id"])
    lengths = packing.token_lengths(docs, tokenizer_file(), 1, with_ids=True)
    pieces = packing.pack(lengths, docs.count())
    texts = {r[0]: r[1] for r in data.rows()}
    seq = {r.sequence_id: np.frombuffer(r.ids, "<u4") for r in packing.sequences(lengths, pieces).collect()}
    for p in pieces.collect():
        want = ids_of(tok, texts[p.doc_id], 1)[p.start:p.start + p.length]
        assert (seq[p.sequence_id][p.offset:p.offset + p.length] == want).all()
