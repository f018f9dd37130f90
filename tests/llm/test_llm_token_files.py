import io
import random
import zlib

import numpy as np
import pytest
import zstandard

from ridemart.llm import token_files as files

TOKENIZER = files.tokenizer_path()
TEXTS = [
    "", " ", "Hello, World!", "don't you'll THE dog's a's'", "x<|endoftext|>, <|ENDOFTEXT|> <|startoftext|>!!", "a b c\x1cd\x85e",
    "été. ́alone Σίσυφος ΟΔΟΣ. İstanbul ẞ ﬁ½ ²³ Ⅷ.", "1,000.50 3.14!!! #tag $5% &amp; **", "tab\tline\nfeed\r\n\v\f end.\n",
    "日本語、テキスト。 한국어! مرحبا بالعالم؟ नमस्ते।", "😀👍🏽 ẹ́ ʰ ª", "...!!!", "a" * 5000 + "! " + "-_" * 300, "ab'cd'S 'S'T it'sn't",
]


@pytest.fixture(scope="module")
def direct():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def test_word_memory_gives_the_ids_of_whole_texts(direct, monkeypatch):
    encoder = files.Encoder(TOKENIZER)
    assert encoder.safe
    rng = random.Random(4)
    letters = "aAbéÉσΣß1½.,!?'’\"<|>#$%& \t\n ́-"
    texts = TEXTS + ["".join(rng.choice(letters) for _ in range(rng.randrange(200))) for _ in range(400)]
    want = [direct(t) for t in texts]
    for characters, remembered in ((1 << 20, 600_000), (50, 10)):
        monkeypatch.setattr(files, "CHARACTERS", characters)
        monkeypatch.setattr(files, "REMEMBERED", remembered)
        assert [np.frombuffer(b, np.uint32).tolist() for b in encoder.encode(texts)] == want


def test_words_met_again_are_not_encoded_again(monkeypatch):
    monkeypatch.setattr(files, "CHARACTERS", 100)
    monkeypatch.setattr(files, "REMEMBERED", 100)
    encoder, learnt, learn = files.Encoder(TOKENIZER), [], files.Encoder._learn
    monkeypatch.setattr(encoder, "_learn", lambda words: (learnt.extend(words), learn(encoder, words))[1])
    texts = [f"Common {'x' * (k % 40)}{chr(97 + k % 26)}{chr(97 + k // 26)} words." for k in range(600)]
    assert sum(1 for _ in encoder.encode(texts)) == 600
    assert learnt.count("Common") == learnt.count("words.") == 1
    # What is remembered stays bounded all the same.
    assert len(encoder.young) + len(encoder.old) < 150


def test_latin_letters_without_the_steps_before_the_model(direct):
    encoder = files.Encoder(TOKENIZER)
    assert encoder.letters is not None
    letters = [chr(c) for c in range(0x21, 0x260)] + ["\u0301", "\u0323", "\u00a0", "\x1c", "\r", "\v"]
    texts = [f"{a} {a}. {a}b{a}!! x{a} {a.upper()}'S{a}#, {a}\u0301. {a}1 <{a}|" for a in letters]
    rng = random.Random(5)
    texts += [" ".join("".join(rng.choices(letters, k=rng.randrange(1, 9))) + rng.choice(["", ".", "...", "&&&"]) for _ in range(20)) for _ in range(400)]
    assert [np.frombuffer(b, np.uint32).tolist() for b in encoder.encode(texts)] == [direct(t) for t in texts]
    # Letters are known to be in one piece, so the shorter way was taken.
    assert encoder._letters(["haus", "stra\u00dfe", "ni\u00f1o"]) == encoder._whole(["haus", "stra\u00dfe", "ni\u00f1o"])


def test_special_tokens_that_look_like_words_take_whole_texts(tmp_path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    tokenizer.add_special_tokens(["[END]."])
    tokenizer.save(path := str(tmp_path / "other.json"))
    texts = ["a [END]. b", "A[END].[end]."]
    got = [np.frombuffer(b, np.uint32).tolist() for b in files.Encoder(path).encode(texts)]
    assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_other_tokenizers_take_whole_texts():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder, direct = files.Encoder(path), Tokenizer.from_file(path)
    assert not encoder.safe
    got = [np.frombuffer(b, np.uint32).tolist() for b in encoder.encode(TEXTS)]
    assert got == [direct.encode(t, add_special_tokens=False).ids for t in TEXTS]


class Buffer(io.BytesIO):
    def size(self):
        return len(self.getbuffer())

    def close(self):
        pass


@pytest.fixture
def written():
    rng = np.random.default_rng(0)
    docs = [(i, rng.integers(0, 2**32, n, dtype=np.uint32)) for i, n in enumerate([3, 0, 10, 64, 1, 200, 0, 5])] + [(5, np.arange(7, dtype=np.uint32)), (None, np.arange(2, dtype=np.uint32))]
    out = Buffer()
    writer = files.Writer(out, frame_ids=16)
    for doc, ids in docs:
        writer.add(doc, ids)
    writer.close()
    return docs, out


def test_round_trip_and_random_access(written):
    docs, out = written
    reader = files.Reader(out)
    assert [reader.document(k).tolist() for k in range(len(docs))] == [ids.tolist() for _, ids in docs]
    assert reader.positions(5) == [5, 8] and reader.positions(None) == [9] and reader.positions(77) == []
    again = files.Reader(out)
    again.document(4)
    assert again.inflated == 1
    again.document(5)
    assert again.inflated <= 1 + 200 // 16 + 2
    # Any zstandard tool can inflate the file: skippable frames hold no content.
    whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(out.getvalue()), read_across_frames=True).read()
    assert np.frombuffer(whole, np.uint32).tolist() == [i for _, ids in docs for i in ids.tolist()]


def test_frames_are_independent(written):
    _, out = written
    reader, data = files.Reader(out), out.getvalue()
    for k, (packed, size, _) in enumerate(reader.frames):
        begin = int(reader.begins[k])
        assert len(zstandard.ZstdDecompressor().decompress(data[begin : begin + packed])) == size


def test_damage_is_noticed(written):
    docs, out = written
    data = out.getvalue()
    for broken in (data[:-1], data[:10], b"", data[:20] + data[21:], data[:-5] + b"\0" + data[-4:]):
        with pytest.raises(files.CorruptFile):
            files.Reader(Buffer(broken))
    flipped = bytearray(data)
    flipped[12] ^= 0xFF
    reader = files.Reader(Buffer(bytes(flipped)))
    with pytest.raises(files.CorruptFile):
        [reader.document(k) for k in range(len(docs))]


def test_nothing_written():
    out = Buffer()
    files.Writer(out).close()
    reader = files.Reader(out)
    assert reader.ids == 0 and len(reader.docs) == 0


@pytest.mark.parametrize("file_ids", [50, 1 << 26])
def test_whole_table(spark, direct, tmp_path, file_ids):
    rows = [(i, t) for i, t in enumerate(TEXTS * 3)] + [(None, "null id"), (None, None), (-4, "b"), (2, "a a"), (2, "a a"), (9999, "word " * 50_000)]
    docs = spark.createDataFrame([(i, t, 1, "s") for i, t in rows], "doc_id long, text string, start int, path string")
    listed = files.write(docs.repartition(4), str(tmp_path / "out"), TOKENIZER, partitions=3, file_ids=file_ids)
    got = files.read(listed, str(tmp_path / "out")).collect()
    ids = {k: [*direct(t or ""), 1] for k, t in enumerate(t for _, t in rows)}
    want = [(i, len(ids[k]), zlib.crc32(np.array(ids[k], "<u4").tobytes())) for k, (i, _) in enumerate(rows)]
    ordered = sorted(got, key=lambda r: r.start)
    assert sorted(((r.key, r.n_tokens, r.ids_crc32) for r in ordered), key=repr) == sorted(want, key=repr)
    keys = [r.key for r in ordered]
    assert keys == sorted((i for i, _ in rows if i is not None)) + [None] * 2
    assert [r.start for r in ordered] == [0, *np.cumsum([r.n_tokens for r in ordered])[:-1].tolist()]
    assert files.read(files.write(docs.limit(0), str(tmp_path / "none"), TOKENIZER), str(tmp_path / "none")).count() == 0


def test_marks_after_letters_that_normalising_changes():
    import sys
    import unicodedata

    path = files.tokenizer_path()
    encoder = files.Encoder(path)
    changed = [c for c in map(chr, range(0x80, sys.maxunicode + 1)) if not 0xD800 <= ord(c) < 0xE000
               and (unicodedata.normalize("NFC", c) != c or c.lower() != c or c.upper() != c)]
    texts = [c + mark for c in changed for mark in ".!,;"] + ["xİ;", "क़.", "ড়!", "שׁ.", "a.", "Été, été."]
    got = list(encoder.encode(texts))
    want = encoder.tokenizer.encode_batch(texts, add_special_tokens=False)
    assert [np.frombuffer(g, np.uint32).tolist() for g in got] == [w.ids for w in want]


def test_many_empty_texts_close_files(spark, tmp_path):
    docs = spark.createDataFrame([(i, "") for i in range(40)], "doc_id long, text string")
    made = files.write(docs, str(tmp_path), files.tokenizer_path(), partitions=1, file_docs=7)
    assert sorted(r.docs for r in made.collect()) == [5, 7, 7, 7, 7, 7]
    found = files.read(made, str(tmp_path)).collect()
    assert sorted((r.key, r.start, r.n_tokens) for r in found) == [(i, i, 1) for i in range(40)]
