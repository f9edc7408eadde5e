import numpy as np
import pytest
from tokenizers import Tokenizer

from statloom.llm import common, packing, tokens, training_order


@pytest.fixture(scope="module")
def encoded(rows):
    """Ids of each row by the library itself, one text at a time."""
    whole = Tokenizer.from_file(tokens.default_path())
    return [whole.encode(r[1] or "", add_special_tokens=False).ids + [2] for r in rows]


def test_encoder_equals_the_library(rows, encoded):
    odd = [
        "<|endoftext|> a<|startoftext|>b", "İstanbul ΣΑΣ ﬁ ２ ½ é ́ ß", "it's they'll 12ab,c!?", "a" * 5000 + " b",
        " x y\x1cz", "日本語 текст عربى", "😀👍🏽 n­b", "a\x00b \x7f", "",
    ]
    whole = Tokenizer.from_file(tokens.default_path())
    encoder = tokens.Encoder(tokens.default_path())
    for texts in (odd, [r[1] or "" for r in rows], odd + [r[1] or "" for r in rows]):
        ids, counts = encoder.encode([t.encode() for t in texts])
        ends = np.cumsum(counts)
        for t, a, b in zip(texts, ends - counts, ends):
            assert ids[a:b].tolist() == whole.encode(t, add_special_tokens=False).ids, t[:40]


def test_other_tokenizers_get_whole_texts():
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder, whole = tokens.Encoder(path), Tokenizer.from_file(path)
    assert not encoder.by_word
    ids, counts = encoder.encode([b"two  words", b""])
    assert ids.tolist() == whole.encode("two  words").ids and counts.tolist() == [len(ids), 0]


@pytest.mark.parametrize(("size", "windows", "merged"), [(64, 3, 2), (4096, 32, 16)])
def test_every_id_in_one_piece(docs, rows, encoded, size, windows, merged):
    pieces = packing.pack(docs.repartition(7), size=size, windows=windows, merged=merged).collect()
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
        assert len(p.ids) == 4 * p.length > 0
    wanted = {}
    for r, ids in zip(rows, encoded):
        wanted.setdefault(r[0], []).append(ids)
    assert set(by_doc) == set(wanted)
    for doc, copies in wanted.items():  # rows of one id are equal
        assert sum(p.length for p in by_doc[doc]) == sum(map(len, copies))
        assert {p.doc_tokens for p in by_doc[doc]} == {len(copies[0])}
        for p in by_doc[doc]:
            assert np.frombuffer(p.ids, "<u4").tolist() == copies[0][p.start : p.start + p.length]
        if len(copies) == 1:
            own = sorted(by_doc[doc], key=lambda p: p.start)
            assert [p.start for p in own] == np.cumsum([0, *(p.length for p in own)])[:-1].tolist()
    sizes = []
    for own in by_sequence.values():
        own = sorted(own, key=lambda p: p.offset)
        assert [p.offset for p in own] == np.cumsum([0, *(p.length for p in own)])[:-1].tolist()
        sizes.append(sum(p.length for p in own))
    short = sorted((s for s in sizes if s != size), reverse=True)
    assert all(s & (s - 1) == 0 and s < size for s in short) and len(set(short)) == len(short)


def test_best_fit_and_fullest():
    packer = packing.Packer(8, 2)
    for n in (5, 6, 2, 3):
        packer.place((n, 0, bytes(4 * n), n))
    # 2 fits best behind 6, 3 behind 5
    assert [[p[0] for p in w] for w in packer.done] == [[6, 2], [5, 3]] and not packer.open
    for n in (5, 6, 4):
        packer.place((n, 0, bytes(4 * n), n))
    # 4 fits nowhere: its head fills up the fullest window, its tail fits behind 5
    assert [[(p[0], p[1], len(p[2]) // 4) for p in w] for w in packer.done[2:]] == [[(6, 0, 6), (4, 0, 2)]]
    assert [(used, [(p[0], p[1]) for p in own]) for used, own in packer.open] == [(7, [(5, 0), (4, 2)])]


def test_empty_table(no_docs):
    assert packing.pack(no_docs).count() == 0
    with pytest.raises(ValueError):
        packing.pack(no_docs, size=100)


# --- training order ---


@pytest.mark.parametrize("total", [1, 2, 3, 16, 17, 1000, 4097])
def test_feistel_permutes(total):
    seen = training_order.feistel(np.arange(total), total, 9)
    assert sorted(seen.tolist()) == list(range(total))
    if total > 100:
        other = training_order.feistel(np.arange(total), total, 10)
        assert (seen != other).mean() > 0.9 and abs(np.corrcoef(np.arange(total), seen)[0, 1]) < 0.2


def test_round_trip_and_resume(spark, docs, rows, encoded):
    path = training_order.new_path(spark)
    places = training_order.materialise_order(docs, path, key=5, length=32, shard_records=50)
    placed = {r.slot: r for r in places.collect()}
    total = len(placed)
    assert sorted(placed) == list(range(total))
    assert sum(r.n_ids for r in placed.values()) == sum(map(len, encoded))
    wanted = {}
    for r, ids in zip(rows, encoded):
        wanted[r[0]] = ids
    whole = {r.slot: np.frombuffer(r.ids, "<u2") for r in training_order.read_slots(spark, path).collect()}
    assert sorted(whole) == list(range(total))
    for slot, ids in whole.items():
        r = placed[slot]
        assert (r.shard, r.offset) == (slot // 50, slot % 50 * 66)
        assert (ids[r.n_ids :] == training_order.PAD_ID).all() and (ids[: r.n_ids] != training_order.PAD_ID).all()
        mine = wanted[r.doc_id][r.start : r.start + r.n_ids]
        assert ids[: len(mine)].tolist() == mine
    streams = sorted(tuple(i[: placed[s].n_ids].tolist()) for s, i in whole.items())
    assert sum(map(len, streams)) == sum(map(len, encoded))
    # a reader goes on from any slot, over the border of a shard
    part = training_order.read_slots(spark, path, 45, 130).collect()
    assert sorted(r.slot for r in part) == list(range(45, min(130, total)))
    assert all((np.frombuffer(r.ids, "<u2") == whole[r.slot]).all() for r in part)


def test_order_of_an_empty_table(spark, no_docs):
    path = training_order.new_path(spark)
    assert training_order.materialise_order(no_docs, path, key=1).count() == 0
    assert training_order.read_slots(spark, path).count() == 0


def test_incomplete_shards_are_an_error(spark, docs):
    import pathlib

    path = training_order.new_path(spark)
    training_order.materialise_order(docs, path, key=3, length=32, shard_records=50)
    file = next(pathlib.Path(path.removeprefix("file:")).glob("shards/shard=1/part-*"))
    whole = file.read_bytes()
    file.write_bytes(whole[:-100])
    for crc in file.parent.glob(".*.crc"):
        crc.unlink()
    with pytest.raises(ValueError):
        training_order.read_slots(spark, path)
    assert training_order.read_slots(spark, path, 100, 120).count() == 20


def test_long_document_is_packed_in_linear_time():
    """Sixteen million ids of one document; copying the rest for each window took over a minute."""
    import time

    packer, raw = packing.Packer(4096, 32), bytes(4 * 16_000_000 + 4 * 5)
    start = time.perf_counter()
    packer.place((1, 0, raw, len(raw) // 4))
    assert len(packer.done) == 16_000_005 // 4096 and time.perf_counter() - start < 5
    assert sum(len(p[2]) for w in packer.done for p in w) + sum(n for n, _ in packer.open) * 4 == len(raw)


def test_frequent_words_are_remembered(monkeypatch):
    monkeypatch.setattr(tokens, "WORDS_KEPT", 40)
    encoder, whole = tokens.Encoder(tokens.default_path()), Tokenizer.from_file(tokens.default_path())
    for k in range(30):
        text = "the river the river the stone the " + " ".join(f"word{k}x{i}" for i in range(25))
        ids, _ = encoder.encode([text.encode()] * 2)
        assert ids.tolist() == whole.encode(text).ids * 2
    assert b"the" in encoder.number and len(encoder.number) < 100


def test_words_numbered_from_bytes():
    """Distinct words, their numbers and counts as by the plain way, for all white space and odd bytes."""
    rnd = np.random.default_rng(6)
    for size in (0, 1, 5, 40):
        texts = [bytes(rnd.choice(list(b"ab \t\n\x0b\x0c\r\x1c\x85\xa0\xc3\x00"), rnd.integers(0, 30)).tolist()) for _ in range(size)]
        plain, counts = common.flat_words(texts)
        distinct, which = common.numbered(plain)
        got = common.distinct_words(texts)
        assert got[0] == distinct and got[1].tolist() == which.tolist() and got[2].tolist() == counts.tolist()


def test_words_of_letters_need_no_pattern(monkeypatch):
    """Runs of letters go to the faster library as they are; their ids are the tokenizer's own."""
    encoder, whole = tokens.Encoder(tokens.default_path()), Tokenizer.from_file(tokens.default_path())
    words = ["Wort", "größe", "ÀÿÖ", "a×b", "÷", "é" * 256, "é" * 257, "a" * 256, "a" * 257, "ćma", "it's", "x7", "a\x7f", "é"]
    plain, letters = encoder._quick([w.encode() for w in words])
    assert [w for w, p in zip(words, plain) if not p] == ["é" * 257, "a" * 257, "ćma", "a\x7f", "é"]
    assert [w for w, one in zip(words, letters) if one] == ["Wort", "größe", "ÀÿÖ", "é" * 256, "a" * 256]
    ids, counts = encoder.encode([w.encode() for w in words])
    wanted = [whole.encode(w, add_special_tokens=False).ids for w in words]
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == wanted
