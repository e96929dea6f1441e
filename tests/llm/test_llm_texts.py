"""Hashes of words and lines, and the shared folder."""

import numpy as np
import pyarrow as pa
import pytest

from opsframe.llm import sorted_counts, texts


def _hashes(words, fold=False):
    part = texts.from_arrow(pa.array(words))
    return texts.hashes(part.data, part.offsets[:-1], part.offsets[1:], fold)


def _mirrored(size):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(size))


def test_no_built_in_collisions():
    words = [w for n in (8, 16, 64, 128, 256, 1024, 4096) for w in (_mirrored(n), _mirrored(n).translate(str.maketrans("ab", "ba")))]
    words += ["", "\0", "\0\0", "a", "a\0", "a" * 8, "a" * 9, "a" * 16, "a" * 127, "a" * 128, "a" * 129]
    words += [f"{a}{b}" for a in ("abcdefgh", "hgfedcba") for b in ("", "12345678", "87654321", "1234567", "12345678" * 2)]
    assert len(set(words)) == len(set(_hashes(words).tolist()))


def test_hashes_depend_on_the_bytes_alone():
    words = ["é", "word", "longer than eight", "x" * 200, "", "Word", "WORD"]
    alone = [int(_hashes([w])[0]) for w in words]
    assert _hashes(words).tolist() == alone and _hashes(["other", *words, "x"])[1:-1].tolist() == alone
    folded = _hashes(words, fold=True)
    assert folded[1] == folded[5] == folded[6] == _hashes(["word"])[0] and alone[1] != alone[5]
    assert _hashes(["É" * 100], fold=True) == _hashes(["É" * 100])


def test_distinct():
    for n in (0, 1, 1000):
        values = np.random.default_rng(n).integers(0, 300, n).astype(np.uint64)
        assert texts.distinct(values).tolist() == sorted(set(values.tolist()))


@pytest.mark.parametrize("uri", ["relative/folder", "viewfs://store/folder", "nothing://x"])
def test_folders_that_cannot_be_shared_are_refused(uri):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        sorted_counts.open_folder(uri)


def test_folders_of_known_stores(tmp_path, monkeypatch):
    for uri in (str(tmp_path), f"file://{tmp_path}", f"file:{tmp_path}"):
        sorted_counts.write_file(uri, "x", [np.arange(5, dtype="<u8")])
        assert sorted_counts.map_file(uri, "x", "<u8").tolist() == list(range(5))
    asked = []
    store = type("Store", (), {"from_uri": staticmethod(lambda uri: asked.append(uri))})
    monkeypatch.setattr(sorted_counts.pafs, "FileSystem", store)
    for scheme in ("s3a", "s3n", "s3"):
        sorted_counts.open_folder(f"{scheme}://bucket/folder")
    assert asked == ["s3://bucket/folder"] * 3
