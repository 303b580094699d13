import random
from hashlib import sha256

from hypothesis import given, settings
from hypothesis import strategies as st

from lorespan.llm import warc

SCHEMA = "page_id long, url string, html string, kind string, size long, digest string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)


def brute(rows):
    first = {}
    for i, _, h in rows:
        p = (h or "").encode()
        if len(p) >= 100 and i is not None:
            first[p] = min(first.get(p, i), i)
    out = []
    for i, _, h in rows:
        p = (h or "").encode()
        refers = first.get(p) if first.get(p) != i else None
        out.append((i, len(p), sha256(p).hexdigest(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


def test_round_trip(spark):
    long = "<p>" + "long text é " * 500_000
    rows = [(k, f"http://x/{k}\r\nInjected: 1", "<html>" + "copy " * 40 + str(k % 3)) for k in range(12)]
    rows += [(20, None, None), (21, "", ""), (22, "u", "small"), (23, "u", "small"), (24, "u", long), (25, "u", long), rows[5]]
    rows += [(None, "u", rows[0][2]), (None, "u", "only without id " * 20), (30, "u", "WARC/1.1\r\n\r\n\x1f" * 30), (31, "u", "é" * 49), (32, "u", "é" * 49), (33, "u", "é" * 50), (34, "u", "é" * 50)]
    got = warc.round_trip(pages(spark, rows)).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == brute(rows)


def test_no_gap_in_sound_files_and_payloads_come_back(spark, tmp_path):
    rows = [(k, "u", f"page {k} " * (k * 30)) for k in range(50)]
    warc.write_archives(pages(spark, rows), str(tmp_path / "a"))
    got = warc.read_archives(spark, str(tmp_path / "a"), payloads=True).collect()
    assert {r.kind for r in got} == {"record"}
    assert {r.page_id: r.payload.decode() for r in got if r.record_type == "response"} == {i: h for i, _, h in rows}


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).collect() == []


def members(n):
    out = []
    for k in range(n):
        payload = (f"payload {k} " * 20).encode()
        out.append(warc.record(k, "u", payload, len(payload), sha256(payload).hexdigest(), None))
    return out


def found(data):
    got = list(warc.salvage(data))
    places = [(g[1], g[2]) for g in got]
    assert all(a[1] <= b[0] or a == b for a, b in zip(places[:-1], places[1:]))
    return [int(g[3]["x-page-id"]) for g in got if g[0] == "record"], [(g[1], g[2]) for g in got if g[0] == "gap"]


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.booleans())
def test_damage_costs_the_damaged_records_only(seed, packed):
    draw = random.Random(seed)
    parts = [warc.gzip_member(m) if packed else m for m in members(8)]
    edges = [0]
    for p in parts:
        edges.append(edges[-1] + len(p))
    data = bytearray(b"".join(parts))
    at = draw.randrange(len(data) - 40)
    for k in range(draw.randrange(1, 30)):
        data[at + k] ^= draw.randrange(1, 256)
    hit = {k for k in range(8) if edges[k] <= at + 29 and at < edges[k + 1]}
    records, gaps = found(bytes(data))
    assert set(range(8)) - hit <= set(records)
    assert records == sorted(records)
    assert sum(b - a for a, b in gaps) <= sum(len(parts[k]) for k in hit)


def test_cut_off_junk_between_and_plain_after_packed():
    one, two, three = members(3)
    data = b"junk" + warc.gzip_member(one) + b"\x00\x1f\x8b\x08junk" + two + warc.gzip_member(three)[:-9]
    records, gaps = found(data)
    assert records == [0, 1]
    assert gaps[0] == (0, 4) and len(gaps) == 3 and gaps[-1][1] == len(data)
    assert found(b"") == ([], []) and found(b"\x1f") == ([], [(0, 1)])
    assert found(warc.gzip_member(one.replace(b"payload 0", b"PAYLOAD 0"))) == ([], [(0, len(warc.gzip_member(one.replace(b"payload 0", b"PAYLOAD 0"))))])


def test_reader_reports_gaps(spark, tmp_path):
    one, two, three = (warc.gzip_member(m) for m in members(3))
    (tmp_path / "x.warc.gz").write_bytes(one + two[:30] + three)
    got = warc.read_archives(spark, str(tmp_path)).orderBy("start").collect()
    assert [(r.kind, r.page_id, r.start, r.end) for r in got] == [
        ("record", 0, 0, len(one)), ("gap", None, len(one), len(one) + 30), ("record", 2, len(one) + 30, len(one) + 30 + len(three))
    ]


def test_digests_of_other_algorithms_and_encodings(spark, tmp_path):
    import base64
    from hashlib import sha1

    payload = b"payload " * 20
    raw1, raw2 = sha1(payload).digest(), sha256(payload).digest()
    forms = ["sha1:" + base64.b32encode(raw1).decode(), "SHA1:" + raw1.hex().upper(), "sha256:" + raw2.hex().upper(), "sha256:" + base64.b32encode(raw2).decode()]
    forms += ["blake3:abc", "sha-256:" + base64.b64encode(raw2).decode(), "sha1:" + base64.b32encode(sha1(b"other").digest()).decode()]
    parts = []
    for k, form in enumerate(forms):
        plain = warc.record(k, "u", payload, len(payload), raw2.hex(), None)
        plain = plain.replace(b"WARC-Payload-Digest: sha256:" + raw2.hex().encode(), b"WARC-Payload-Digest: " + form.encode())
        block = plain.split(b"\r\n\r\n", 1)[1][:-4]
        parts.append(plain.replace(sha256(block).hexdigest().encode(), sha256(block).hexdigest().upper().encode()))
    (tmp_path / "x.warc").write_bytes(b"".join(parts))
    got = warc.read_archives(spark, str(tmp_path)).orderBy("start").collect()
    assert [(r.kind, r.page_id) for r in got] == [("record", k) for k in range(6)] + [("gap", None)]
    assert {r.payload_digest for r in got[:6]} == {raw2.hex()} and got[6].reason == "payload digest differs"


def test_members_of_several_records_lose_the_bad_ones_only():
    parts = members(6)
    parts[2] = parts[2].replace(b"payload 2", b"PAYLOAD 2")
    data = warc.gzip_member(b"".join(parts))
    assert found(data) == ([0, 1, 3, 4, 5], [(0, len(data))])
    whole = warc.gzip_member(b"".join(members(40)))
    records, gaps = found(whole[: len(whole) * 2 // 3])
    assert 10 < len(records) < 40 and records == list(range(len(records)))
    assert len(gaps) == 1 and gaps[0][1] == len(whole) * 2 // 3
    records, gaps = found(whole[: len(whole) * 2 // 3] + warc.gzip_member(members(41)[40]))
    assert len(records) > 10 and records[-1] == 40
    wrong_sum = whole[:-8] + bytes(8)
    assert found(wrong_sum)[0] == list(range(39)) and len(found(wrong_sum)[1]) == 1
