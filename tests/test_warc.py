"""Reading WARC files from any place, and past damage."""

import gzip
import io
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pagemill.sources import archive, warc


def good(i, body=None):
    return warc.write_record(f"http://h/{i}", body or b"<p>%d</p>" % i)


def oversized(i, extra=10**6):
    head, _, rest = good(i).partition(b"Content-Length: ")
    n, _, rest = rest.partition(b"\r\n")
    return head + b"Content-Length: %d\r\n" % (int(n) + extra) + rest


def seen(data, split=None):
    return [(r["warc_type"], r["target_uri"]) for r in warc.records(io.BytesIO(data))]


def uris(found):
    return [u for kind, u in found if kind == "response"]


@pytest.mark.parametrize("extra", [7, 90, 300, 10**6, 3 * 10**9])
@pytest.mark.parametrize("packed", [False, True])
def test_a_length_too_large_loses_one_record(extra, packed):
    pack = gzip.compress if packed else bytes
    found = seen(b"".join(map(pack, [good(0), oversized(1, extra), good(2), good(3)])))
    assert uris(found) == [f"http://h/{i}" for i in (0, 2, 3)]
    assert [k for k, _ in found].count("damaged") == 1


def test_a_broken_member_loses_one_record():
    members = [gzip.compress(good(i, bytes(random.Random(i).randbytes(5000)))) for i in range(4)]
    for at in range(0, len(members[1]), 97):
        broken = bytearray(members[1])
        broken[at : at + 4] = b"\xff\x00\xff\x55"
        found = seen(members[0] + bytes(broken) + members[2] + members[3])
        assert [u for u in uris(found) if u != "http://h/1"] == [f"http://h/{i}" for i in (0, 2, 3)]
        assert all(k in ("response", "damaged") and u for k, u in found) and len(found) <= 5


def test_one_member_for_all_gives_what_comes_before_the_damage():
    data = bytearray(gzip.compress(b"".join(good(i, random.Random(i).randbytes(3000)) for i in range(40))))
    data[len(data) // 2] ^= 0x55
    found = seen(bytes(data))
    assert uris(found)[:15] == [f"http://h/{i}" for i in range(15)] and found[-1][0] == "damaged"


def test_lengths_too_small_and_rubbish_between():
    short = good(1, b"x" * 100).replace(b"Content-Length: 1", b"Content-Length: ", 1)
    found = seen(good(0) + short + b"rubbish\r\nmore\r\n" + good(2))
    assert uris(found)[0] == "http://h/0" and uris(found)[-1] == "http://h/2"
    assert [k for k, _ in found].count("damaged") == 1
    assert seen(b"") == [] and seen(b"\r\n\r\n") == []
    assert [k for k, _ in seen(b"no archive at all")] == ["damaged"]
    assert [k for k, _ in seen(good(0)[:30])] == ["damaged"]


def test_records_over_members():
    """Members that end anywhere, as block compressors make them."""
    data = b"".join(good(i, random.Random(i).randbytes(900)) for i in range(20))
    cut = b"".join(gzip.compress(data[k : k + 512]) for k in range(0, len(data), 512))
    assert uris(seen(cut)) == [f"http://h/{i}" for i in range(20)]


def chained(data, split):
    """What the ranges of one file give, each entered where the one before says, in one process."""
    out, due = [], 0
    for start in range(0, len(data), split):
        end = min(start + split, len(data))
        if due >= end:
            continue
        s, after = archive.opened(io.BytesIO(data)), []
        s.jump(due)
        out += [(r["warc_type"], r["target_uri"]) for r in warc.rows_of(s, end, after)]
        due = after[0]
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["good", "big", "oversized", "nested", "rubbish", "broken", "empty"]), min_size=1, max_size=12), st.booleans(), st.integers(50, 3000))
def test_ranges_give_what_the_whole_gives(kinds, packed, split):
    parts = []
    for i, kind in enumerate(kinds):
        r = random.Random(i)
        body = {"big": r.randbytes(2500), "nested": good(100 + i) * 2, "empty": b" "}.get(kind)
        raw = b"rubbish\r\nlines\r\n" if kind == "rubbish" else oversized(i) if kind == "oversized" else good(i, body)
        if packed:
            raw = bytearray(gzip.compress(raw, 0 if kind == "nested" else 6))
            if kind == "broken":
                raw[len(raw) // 2] ^= 0xFF
        elif kind == "broken":
            raw = raw[:-30]
        parts.append(bytes(raw))
    data = b"".join(parts)
    whole = seen(data)
    assert chained(data, split) == whole
    intact = [f"http://h/{i}" for i, k in enumerate(kinds) if k in ("good", "big", "nested", "empty") and "rubbish" not in kinds[i + 1 : i + 2]]
    if packed or "broken" not in kinds:
        assert set(intact) <= set(uris(whole))


def files(tmp_path, packed):
    """Two files with damage, payloads that hold records themselves, and (packed) members stored inside members."""
    for name, n in (("a", 60), ("b", 7)):
        out = []
        for i in range(n):
            r = random.Random(i)
            inner = b"".join(good(1000 + k, b"inner" * 20) for k in range(12))
            body = (gzip.compress(inner[: len(inner) // 12]) * 12 if packed else b"x\r\n\r\n" + inner) if i % 4 == 1 else r.randbytes(r.randint(10, 4000))
            raw = oversized(i) if i % 9 == 5 else good(i, body)
            out.append((zlib_stored(raw) if i % 4 == 1 else gzip.compress(raw)) if packed else raw)
        (tmp_path / f"{name}.warc{'.gz' if packed else ''}").write_bytes(b"".join(out))


def zlib_stored(raw):
    c = zlib.compressobj(0, zlib.DEFLATED, 31)
    return c.compress(raw) + c.flush()


@pytest.mark.parametrize("packed", [False, True])
@pytest.mark.parametrize("split", [700, 5000, 1 << 20])
def test_one_file_in_several_tasks(spark, tmp_path, packed, split):
    files(tmp_path, packed)
    want = sorted((f"file://{p}", r["warc_type"], r["target_uri"], bytes(r["payload"])) for p in tmp_path.iterdir() for r in warc.records(io.BytesIO(p.read_bytes())))
    assert [u for _, k, u, _ in want if k == "response" and u.startswith("http://h/1") and len(u) > 12] == []  # nothing from inside a payload
    got = warc.read_warc(spark, str(tmp_path), split)
    assert sorted((r.path, r.warc_type, r.target_uri, bytes(r.payload)) for r in got.collect()) == want
    if split == 5000:
        parts = [r for r in warc.ranges_of(spark, warc.listed(str(tmp_path)), split) if r[5] >= 0]
        assert len(parts) > 4


def test_a_folder_without_files(spark, tmp_path):
    assert warc.read_warc(spark, str(tmp_path)).count() == 0
    (tmp_path / "e.warc").write_bytes(b"")
    assert warc.read_warc(spark, str(tmp_path)).count() == 0
