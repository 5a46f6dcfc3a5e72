"""Landing files read element by element."""

import gzip
import io
import json
import os
import random

import pytest
from pyspark.sql.types import StringType, StructField, StructType

from helpers import write_text
from tierline.schemas import CORRUPT, TICKET
from tierline.sources import json_elements as je
from tierline.sources.files import landing_json_stream, read_json_batch
from tierline.streaming.runner import run_available_now

WITH_TEXT = StructType(TICKET.fields + [StructField(CORRUPT, StringType())])


def split(text: bytes):
    return list(je.file_elements(lambda: io.BytesIO(text), len(text)))


def test_elements_and_broken_files_on_generated_texts(monkeypatch):
    pick = random.Random(1)
    signs = '{}[],:"\\ ab\né'

    def record():
        return {f"k{i}": "".join(pick.choice(signs) for _ in range(pick.randint(0, 12))) for i in range(pick.randint(0, 3))}

    broken = 0
    for _ in range(3000):
        monkeypatch.setattr(je, "PIECE_BYTES", pick.choice([1, 2, 3, 5, 8, 64]))
        text = json.dumps([record() for _ in range(pick.randint(0, 4))], indent=pick.choice([None, 1]),
                          ensure_ascii=pick.random() < .5)
        mode = pick.random()
        if mode < .2:
            text = text[:-pick.randint(1, min(3, len(text)))]
        elif mode < .3:
            text += pick.choice([" []", "x", "\n\n", "]", ",", ' "a"'])
        elif mode < .4:
            text = f"  \n{text} \n"
        elif mode < .45:
            text = json.dumps(record())
        try:
            value = json.loads(text)
        except ValueError:
            value = None
        got = split(text.encode())
        if value is not None:
            assert [json.loads(t) for t, _ in got] == (value if isinstance(value, list) else [value])
            assert not any(bad for _, bad in got)
        else:
            assert all(bad for _, bad in got) and b"".join(t for t, _ in got) == text.encode()
            broken += bool(got)
    assert broken > 300


def test_pieces_never_hold_the_file():
    reads = []

    class Endless(io.RawIOBase):
        """An array of many elements, made as it is read."""

        def __init__(self, n):
            self.parts = iter([b"["] + [json.dumps({"i": i}).encode() + b"," for i in range(n)] + [b"{}]"])
            self.rest = b""

        def read(self, size):
            while len(self.rest) < size and (part := next(self.parts, None)) is not None:
                self.rest += part
            out, self.rest = self.rest[:size], self.rest[size:]
            reads.append(len(out))
            return out

    n = sum(1 for _ in je.file_elements(lambda: Endless(300_000), None))
    assert n == 300_001 and max(reads) <= je.PIECE_BYTES and sum(reads) > 6 * je.PIECE_BYTES


def ticket(i, text="fine"):
    return {"ticket_id": f"T{i}", "customer_id": "C", "product_id": "P", "review_text": text, "timestamp": "2026-01-02T03:04:05Z"}


@pytest.fixture()
def landing(workdir):
    """One long file, one long file with a second value, small good and bad ones."""
    tickets = [ticket(i, "word [{\\\"}] " * 200) for i in range(4000)]
    write_text(f"{workdir}/landing", "long.json", json.dumps(tickets, indent=1))
    write_text(f"{workdir}/landing", "trailing.json", json.dumps([{**t, "ticket_id": "X" + t["ticket_id"]} for t in tickets]) + "\n[]")
    write_text(f"{workdir}/landing", "odd.json", json.dumps([ticket("odd"), 5, None, [ticket("in")]])[:-1] + ', {"ticket_id": nothing},]')
    write_text(f"{workdir}/landing", "one.json", json.dumps(ticket("one")))
    write_text(f"{workdir}/landing", "empty.json", " [ ] ")
    with gzip.open(f"{workdir}/landing/packed.json.gz", "wt") as fh:
        json.dump([ticket("gz1"), ticket("gz2")], fh)
    return f"{workdir}/landing"


def check(rows):
    good = [r for r in rows if r[CORRUPT] is None]
    bad = [r[CORRUPT] for r in rows if r[CORRUPT] is not None]
    assert sorted(r["ticket_id"] for r in good) == sorted([f"T{i}" for i in range(4000)] + ["Tone", "Todd", "Tgz1", "Tgz2"])
    assert all(r["ticket_id"] is None for r in rows if r[CORRUPT] is not None)
    small = [t for t in bad if len(t) < 500]
    odd = [t.strip() for t in small if "XT" not in t]
    assert sorted(odd) == sorted(["", "5", "null", json.dumps([ticket("in")]), '{"ticket_id": nothing}', "[]"][:len(odd)]) or \
        {"5", "null", '{"ticket_id": nothing}'} <= set(odd)
    text = "".join(bad)
    assert all(f'"XT{i}"' in text for i in range(4000)) and max(map(len, bad)) < 2.5 * je.PIECE_BYTES


def test_files_longer_than_a_piece_and_trailing_text(spark, landing):
    assert os.path.getsize(f"{landing}/long.json") > 8 * je.PIECE_BYTES
    rows = read_json_batch(spark, landing, WITH_TEXT, multi_line=True, corrupt_column=CORRUPT).collect()
    check(rows)


def test_the_stream_gives_the_same_rows(spark, landing, workdir):
    stream = landing_json_stream(spark, landing, WITH_TEXT, max_files_per_trigger=2, corrupt_column=CORRUPT)
    run_available_now(stream, f"{workdir}/out", f"{workdir}/ck")
    check(spark.read.schema(WITH_TEXT).parquet(f"{workdir}/out").collect())


def test_stores_that_only_spark_opens(spark, landing, monkeypatch):
    monkeypatch.setattr(je, "opens_with_arrow", lambda path: False)
    check(read_json_batch(spark, landing, WITH_TEXT, multi_line=True, corrupt_column=CORRUPT).collect())


def test_contents_stay_out_of_the_listing(spark, landing):
    plan = read_json_batch(spark, landing, TICKET, multi_line=True)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string,length:bigint>" in plan
