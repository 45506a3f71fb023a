"""Chunked ingest: the digests of whole files, the cap, files above what a row can hold, and files that are no books."""

import hashlib
import io

from varaq.sources import books, ingest


def test_a_folder_is_ingested_as_the_whole_files_are(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"%PDF-1.4 " + b"x" * 100_000)
    (tmp_path / "b.PDF").write_bytes(b"PK" * 50)
    (tmp_path / "c.txt").write_bytes(b"%PDF-")
    (tmp_path / "کتاب اول.pdf").write_bytes(b"%PDF-" + bytes(range(256)) * 40)
    (tmp_path / "big.pdf").write_bytes(b"%PDF-" + b"y" * 300_000)
    at = f"file://{tmp_path}"
    got = {r.name: r for r in ingest.ingested(spark, at, max_bytes=200_000, chunk=1000).collect()}
    whole = {r.name: r for r in books.book_files(spark, at, max_bytes=200_000).collect()}
    assert {k: (r.error, r.size) for k, r in got.items()} == {k: (r.error, r.size) for k, r in whole.items()}
    for name in ("a.pdf", "کتاب اول.pdf"):
        assert got[name].sha256 == whole[name].sha256 == hashlib.sha256((tmp_path / name).read_bytes()).hexdigest() and got[name].modified == whole[name].modified
    assert (got["big.pdf"].error, got["big.pdf"].sha256, got["b.PDF"].error) == ("too_large", None, "not_a_pdf")


def test_a_file_that_no_row_can_hold(spark, tmp_path):
    """2.2 GB, most of it a hole of the file system."""
    size = 2_200_000_000
    with open(tmp_path / "huge.pdf", "wb") as f:
        f.write(b"%PDF-")
        f.truncate(size)
    r = ingest.ingested(spark, f"file://{tmp_path}", max_bytes=3 << 30).first()
    want, block = hashlib.sha256(b"%PDF-"), bytes(1 << 24)
    for _ in range((size - 5) // len(block)):
        want.update(block)
    want.update(bytes((size - 5) % len(block)))
    assert (r.size, r.sha256, r.error) == (size, want.hexdigest(), None)


class Counting(io.BytesIO):
    taken = 0

    def read(self, n=-1):
        out = super().read(n)
        self.taken += len(out)
        return out


def test_reading_stops_at_the_cap_and_at_what_is_no_book():
    long = Counting(b"%PDF-" + b"x" * 1_000_000)
    assert ingest.digest(long, 10_000, 1000) == (11_000, None, "too_large") and long.taken == 11_000
    other = Counting(b"PK" + b"x" * 1_000_000)
    assert ingest.digest(other, 10_000, 1000) == (1000, None, "not_a_pdf") and other.taken == 1000
    exact = b"%PDF-" + b"x" * 5
    assert ingest.digest(Counting(exact), 10, 3)[2] == "not_a_pdf"  # a chunk must hold the beginning
    assert ingest.digest(Counting(exact), 10, 7) == (10, hashlib.sha256(exact).hexdigest(), None)
    assert ingest.digest(Counting(b""), 10, 7) == (0, None, "not_a_pdf")
