"""Chat formatting and WARC archives: exact round trips."""

import base64
import gzip
import hashlib
import os

import pytest

from logloom.llm import chat, warc

TURNS = "conv_id long, turn long, role string, text string, segment string"


def turns():
    texts = ["hi", "</s>[INST] ok [/INST]", "a\\b\\\\l [x] <y>", "", None, "<", "s>", "é 😀 [ROLE x] [/ROLE]", "<</s>s>", "\\"]
    roles = ["user", "assistant", "system", "tool [x] é", None]
    rows = [(c, t, roles[(c + t) % 5], texts[(3 * c + t) % 10], "clash") for c in range(8) for t in range(12)]
    return rows + [rows[5], (None, 0, "user", "x", None), (None, None, "assistant", "y", None), (7, None, "user", "z", None)]


def test_chat_round_trip(spark):
    df = spark.createDataFrame(turns(), TURNS).repartition(4)
    segments = chat.formatted(df)
    got = {r.conv_id: r for r in chat.read_back(segments).collect()}
    text = {}
    for c, t, role, content, _ in turns():
        text.setdefault(c, []).append((t is not None, t, (role or "").encode(), (content or "").encode()))
    whole = {}
    for r in segments.orderBy("place").collect():
        whole[r.conv_id] = whole.get(r.conv_id, b"") + bytes(r.segment)
    assert set(got) == set(text)
    for c, rows in text.items():
        rows.sort(key=lambda r: (r[0], r[1] or 0, r[2], r[3]))
        loss = b"".join(x for _, _, role, x in rows if role == b"assistant")
        r = got[c]
        assert r.n_turns == len(rows)
        assert r.turns_sha256 == hashlib.sha256(b"".join(a + b"\n" + x + b"\n" for _, _, a, x in rows)).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(loss.decode()), hashlib.sha256(loss).hexdigest())
        assert r.formatted_chars == len(whole[c].decode())
    assert chat.read_back(chat.formatted(df.limit(0))).count() == 0


def test_escapes_leave_no_control_string():
    import pyarrow as pa

    from logloom.llm.flat import blocks
    texts = [x for _, _, _, x, _ in turns() if x is not None]
    _, _, block = next(blocks(pa.array(texts)))
    buffer, at, start, stop = chat.assemble([b"user"] * len(texts), block)
    for i, text in enumerate(texts):
        segment = buffer[at[i]:at[i + 1]].tobytes()
        content = segment[start[i]:stop[i]]
        assert not any(c in content for c in chat.CONTROL)
        assert chat.unescape(content).decode() == text and chat.parse(segment) == (b"user", text.encode())
    assert chat.parse(chat.frame(b"x y")[0] + b"t" + chat.frame(b"x y")[1]) == (b"x y", b"t")


def pages():
    rows = [(i, f"http://x/{i}", f"<p>page {i % 5} é</p>", "c") for i in range(23)]
    return rows + [(30, None, None, "c"), (31, "u\r\nv", "", "c"), (32, "u", "x" * 300_000, None), (7, "again", "<p>own</p>", "c"),
                   (40, "same", "<p>twice</p>", "c"), (40, "same", "<p>twice</p>", "c"), (None, "n", "<p>page 0 é</p>", "c"),
                   (None, "n", "<p>nameless</p>", "c")]


def test_warc_round_trip(spark, tmp_path):
    df = spark.createDataFrame(pages(), "page_id long, url string, html string, refers_to string").repartition(3)
    got = warc.round_trip(df, f"file://{tmp_path}/a").collect()
    payloads, want = {}, []
    for page, _, html, _ in pages():
        payloads.setdefault((html or "").encode(), []).append(page)
    for payload, ids in payloads.items():
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        top = max((i for i in ids if i is not None), default=None)
        for i in ids:
            first = i == top
            want.append((i, len(payload), digest, "response" if first else "revisit", None if first else top))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert warc.round_trip(df.limit(0), f"file://{tmp_path}/b").count() == 0
    files = os.listdir(tmp_path / "a")
    assert files and all(gzip.open(tmp_path / "a" / f).read().startswith(b"WARC/1.1\r\n") for f in files)


def test_many_small_archives(spark, tmp_path):
    df = spark.createDataFrame(pages(), "page_id long, url string, html string, refers_to string").coalesce(1)
    listed = warc.archived(df, str(tmp_path / "s"), archive_bytes=200).collect()
    assert len(listed) > 5 and sum(r.records for r in listed) == len(pages())
    members = []
    with open(listed[0].path.removeprefix("file://"), "rb") as stream:
        members = list(warc.members(stream, read_bytes=7))
    assert len(members) == listed[0].records


@pytest.mark.parametrize("change", ["payload", "length", "cut"])
def test_damage_is_found(tmp_path, change):
    data = warc.record(1, "u", b"<p>text</p>", None, True)
    if change == "payload":
        data = data.replace(b"text", b"tent")
    if change == "length":
        data = data.replace(b"Content-Length: 104", b"Content-Length: 103") if b"Content-Length: 104" in data else data[:-1]
    with pytest.raises(ValueError):
        if change == "cut":
            import io
            list(warc.members(io.BytesIO(warc.member(data)[:-12])))
        else:
            warc.row_of(data)
