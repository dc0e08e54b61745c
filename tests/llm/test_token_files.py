"""Token files: the round trip against encoding each text by itself, the layout, units."""

import json
import random
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from llm_words import no_documents, odd  # noqa: F401
from pyspark.sql import functions as F

from daybook.llm.pieces import PieceIds, added_strings, cut_pieces
from daybook.llm.token_files import TokenSource, byte_sizes, manifest_of, read_tokens, with_token_ids, write_tokens
from daybook.llm.units import UnitIds, cut_units
from daybook.settings import setting

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_50k.json")
PIECES = ["a", "bc", " ", "  ", "\n", "\t", " ", "　", "᠎", "​", "'s", ".", "12", "é", "雪", "🙂",
          "<|endoftext|>", "́", " \n", "\x1c", "\x85", " ", "▁"]


def odd_texts(seed, count):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 14))) for _ in range(count)]


@pytest.mark.parametrize("special", [True, False])
def test_units_have_the_ids_of_the_text(special):
    made = Tokenizer.from_file(PATH)
    made.encode_special_tokens = not special
    texts = odd_texts(1, 4000)
    words, units, ends = cut_units(pa.array(texts))
    first = 0
    for text, last, whole in zip(texts, ends, made.encode_batch(texts, add_special_tokens=False), strict=True):
        own = [words[int(u)].as_py() for u in units[first:last]]
        first = last
        assert " ".join(own) == text
        parts = [own[0], *[" " + w for w in own[1:]]]
        assert [i for p in parts for i in made.encode(p, add_special_tokens=False).ids] == whole.ids


def test_unit_ids_are_looked_up_forgotten_and_told_apart(monkeypatch):
    """Units that several texts share are encoded once; an encoder whose ids do not tell where
    units end is asked for each."""
    monkeypatch.setattr("daybook.llm.units.REMEMBERED", 3)
    asked = []

    def letters(texts):
        asked.extend(texts)
        return [[ord(c) for c in t] for t in texts]

    held = UnitIds(letters, np.ones(128, np.int64), " ")
    for words in (["a", "bb", "x" * 200], ["bb", "x" * 200, "dddd"], ["e ", "", "a", "f", "a"]):
        flat, starts, sizes = held.of(pa.array(words))
        got = ["".join(map(chr, flat[s : s + n])) for s, n in zip(starts, sizes, strict=True)]
        assert got == [" " + w for w in words]
    assert asked[:2] == [" a bb " + "x" * 200, " " + "x" * 200 + " dddd"]
    odd_one = UnitIds(lambda texts: [[len(t)] for t in texts], np.full(128, 2), " ")
    flat, starts, sizes = odd_one.of(pa.array(["aa", "b"]))
    assert [flat[s : s + n].tolist() for s, n in zip(starts, sizes, strict=True)] == [[3], [2]]


def test_units_that_are_met_again_are_kept(monkeypatch):
    """When there are too many, only units met once are encoded anew; ids stay right."""
    monkeypatch.setattr("daybook.llm.units.REMEMBERED", 6)
    asked = Counter()

    def letters(texts):
        asked.update(w for t in texts for w in t.split())
        return [[ord(c) for c in t] for t in texts]

    held = UnitIds(letters, np.ones(128, np.int64), " ")
    for turn in range(12):
        words = ["the", f"a{turn}", "of", f"b{turn}", "once" if turn in (0, 11) else f"c{turn}", "x" * 200]
        flat, starts, sizes = held.of(pa.array(words))
        assert ["".join(map(chr, flat[s : s + n])) for s, n in zip(starts, sizes, strict=True)] == [" " + w for w in words]
        assert held.count <= 12
    assert asked["the"] == asked["of"] == 1 and asked["once"] == 2 and asked["x" * 200] == 12
    many = UnitIds(letters, np.ones(128, np.int64), " ")
    for _ in range(3):  # more that are met again than may be kept
        for words in ([f"m{k}" for k in range(5)], [f"n{k}" for k in range(5)]):
            flat, starts, sizes = many.of(pa.array(words))
            assert ["".join(map(chr, flat[s : s + n])) for s, n in zip(starts, sizes, strict=True)] == [" " + w for w in words]
            assert many.count <= 12


MORE = ["A", "ßÀ", "×", "ª", "²", "'", "'ll", "d", "7", "&&", "-", " ", " ", "\n", "\r\n", "\x0b", "я", "–", "½", "\x00",
        "\u2028", "\u00a0", "\u1680", "٣", "ﬁ", "\ufeff", "₂", "»", "\U0001d7d8", "E", "\x7f"]


def in_pieces(made, texts, asked=None):
    """The ids of ``texts`` by pieces, several texts at a time."""

    def encoded(parts):
        if asked is not None:
            asked.extend(parts)
        return [e.ids for e in made.encode_batch_fast(parts, add_special_tokens=False)]

    added, out = added_strings(made), []
    held = PieceIds(encoded, byte_sizes(made), added is not None)
    for low in range(0, len(texts), 500):
        words, pieces, ends = cut_pieces(pa.array(texts).slice(low, 500), added)
        assert len(set(words.to_pylist())) == len(words)
        flat, starts, sizes = held.of(words)
        for first, last in zip([0, *ends[:-1]], ends, strict=True):
            out.append([i for p in pieces[first:last] for i in flat[starts[p] : starts[p] + sizes[p]].tolist()])
    return out, held


@pytest.mark.parametrize("special", [True, False])
@pytest.mark.parametrize("remembered", [1 << 19, 60])
def test_pieces_have_the_ids_of_the_text(monkeypatch, special, remembered):
    monkeypatch.setattr("daybook.llm.pieces.REMEMBERED", remembered)
    made = Tokenizer.from_file(PATH)
    made.encode_special_tokens = not special
    rng = random.Random(5)
    texts = ["".join(rng.choice(PIECES + MORE) for _ in range(rng.randint(0, 16))) for _ in range(20_000)]
    texts += ["", "x" * 300, "\n", " ", "'", "don't we'll", "\nA", "A\n", "A\n\nB", "the.\nNext"]
    found, held = in_pieces(made, texts)
    assert found == [e.ids for e in made.encode_batch(texts, add_special_tokens=False)]
    assert len(held.words) <= remembered


@pytest.mark.parametrize("special", [True, False])
def test_words_are_encoded_once_whatever_follows_them(special):
    """A word with a mark or line end after it is no new one, but in texts with special tokens."""
    made = Tokenizer.from_file(PATH)
    made.encode_special_tokens = not special
    words = [f"{a}{b}" for a in ("lich", "thé", "Qu") for b in ("on", "ß", "ly", "er")]
    texts = [f"so {w}{m}{v}" for w in words for m in (".", ",", "&&&", ".\n", "\n", "; ", " ", "12") for v in words]
    texts.append("so lich<|endoftext|>.on")
    asked = []
    found, _ = in_pieces(made, texts, asked)
    assert found == [e.ids for e in made.encode_batch(texts, add_special_tokens=False)]
    assert sum(map(len, asked)) < 20 * len(words)


def test_other_tokenizers_get_whole_texts():
    """Where the pattern is not the usual one, nothing is cut; an added token is found where it
    would be cut."""
    from tokenizers import pre_tokenizers

    texts = ["the end.\nOf <the> end", "", " a  b's", "the <the>the"]
    made = Tokenizer.from_file(PATH)
    made.encode_special_tokens = True
    made.add_tokens(["<the>"])
    found, held = in_pieces(made, texts)
    assert found == [e.ids for e in made.encode_batch(texts, add_special_tokens=False)] and held.joined
    made.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=True)
    found, held = in_pieces(made, texts)
    assert found == [e.ids for e in made.encode_batch(texts, add_special_tokens=False)] and not held.joined


def expected(rows):
    """In order of key, then as read: place, number and ids of every text."""
    made = Tokenizer.from_file(PATH)
    return {key: [*made.encode(text or "", add_special_tokens=False).ids, 2] for key, text in rows}


def test_round_trip(spark, tmp_path, odd):
    rows = [(k, t) for k, t in enumerate([*odd_texts(2, 60), None, "", "word " * 30_000])]
    random.Random(0).shuffle(rows)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    path = str(tmp_path / "tokens")
    write_tokens(frame, path, PATH, end_id=2)
    got = read_tokens(spark, path).collect()
    want, base = expected(rows), 0
    assert sorted(r["key"] for r in got) == sorted(want)
    for row in sorted(got, key=lambda r: r["key"]):
        ids = want[row["key"]]
        assert (row["start"], row["n_tokens"], list(row["ids"])) == (base, len(ids), ids)
        assert zlib.crc32(row["id_bytes"]) == zlib.crc32(np.array(ids, "<u4").tobytes())
        base += len(ids)
    # any file can be mapped as it lies: ids, and offsets from 0 on
    manifest = manifest_of(path)
    for name, docs, tokens, _, start in manifest["files"]:
        flat = np.memmap(f"{path}/{name}.bin", "<u2", "r")
        offsets = np.memmap(f"{path}/{name}.idx", "<i8", "r")
        assert len(flat) == tokens == offsets[-1] and len(offsets) == docs + 1
        key = next(r["key"] for r in got if r["start"] == start)
        assert flat[offsets[0] : offsets[1]].tolist() == want[key]


def test_repeated_keys_nulls_and_names(spark, tmp_path, odd):
    """Repeated and null keys are documents of their own; other columns are no matter."""
    path = str(tmp_path / "tokens")
    frame = odd.withColumns({"key": F.lit("x"), "ids": F.lit(1), "_hash": F.lit(2), "given": F.lit(3)})
    write_tokens(frame, path, PATH, end_id=2)
    got = read_tokens(spark, path, "start long, key long, n_tokens long").orderBy("start").collect()
    keys = [r["key"] for r in got]
    assert keys == sorted((r["doc_id"] for r in odd.collect()), key=lambda k: (k is not None, k))
    sizes = [r["n_tokens"] for r in got]
    assert [r["start"] for r in got] == [sum(sizes[:k]) for k in range(len(sizes))]
    out = with_token_ids(frame, PATH, None)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "key", "_hash", "given", "ids"]
    assert [list(r["ids"]) for r in out.where("text is null or text = ''").collect()] == [[], []]


def test_hot_key_is_dealt_out(spark, tmp_path):
    """Rows of one key, even of one text, go to several files."""
    path = str(tmp_path / "tokens")
    rows = spark.range(30_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("same words " * 40).alias("text"))
    with setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
        write_tokens(rows, path, PATH, end_id=2)
    docs = [f[1] for f in manifest_of(path)["files"]]
    assert sum(docs) == 30_000 and max(docs) < 10_000


def test_files_roll_and_are_read_in_parts(spark, tmp_path):
    spark.dataSource.register(TokenSource)
    path = str(tmp_path / "tokens")
    rows = spark.range(3000, numPartitions=2).select(
        F.col("id").alias("key"), F.expr("sequence(0, CAST(id % 50 AS INT))").alias("ids")
    )
    with setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", "200"):
        for _ in range(2):  # appended, the second set goes on where the first ends
            rows.write.format("tokens").option("width", "2").option("maxFileBytes", "20000").mode("append").save(path)
    files = manifest_of(path)["files"]
    assert len(files) > 4 and sum(f[1] for f in files) == 6000
    assert all(a[4] + a[2] == b[4] and a[3] + a[1] == b[3] for a, b in zip(files, files[1:], strict=False))
    read = spark.read.format("tokens").option("maxPartitionBytes", "5000").schema("key long, start long, ids array<int>")
    read = read.load(path)
    assert read.rdd.getNumPartitions() > len(files)
    got = read.collect()
    assert len({r["start"] for r in got}) == 6000
    assert all(list(r["ids"]) == list(range(r["key"] % 50 + 1)) for r in got)
    with pytest.raises(Exception, match="another width"):
        rows.write.format("tokens").mode("append").save(path)


def test_ids_that_do_not_fit_and_unfinished_sets(spark, tmp_path):
    spark.dataSource.register(TokenSource)
    large = spark.range(1).select(F.col("id").alias("key"), F.array(F.lit(70_000)).alias("ids"))
    with pytest.raises(Exception, match="does not fit"):
        large.write.format("tokens").option("width", "2").mode("append").save(str(tmp_path / "a"))
    with pytest.raises(Exception, match="no finished token files"):
        read_tokens(spark, str(tmp_path / "a")).collect()
    large.write.format("tokens").mode("append").save(str(tmp_path / "b"))
    assert [list(r["ids"]) for r in read_tokens(spark, str(tmp_path / "b")).collect()] == [[70_000]]


def test_empty_table(spark, tmp_path, no_documents):
    path = str(tmp_path / "tokens")
    write_tokens(no_documents, path, PATH, end_id=2)
    assert read_tokens(spark, path).collect() == []
    assert json.loads(Path(path, "_manifest.json").read_text())["files"] == []
