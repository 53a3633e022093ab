"""Tables through Spark, the file source, sessions, streams and the client."""

import datetime as dt
import socket
import struct
import threading
import time

import pyarrow as pa
import pytest
from conftest import SMALL
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.errors import AuthFailed, CallError, ConnectionFailed, RemoteError
from tidewire.operators import qexpr, relational, tables
from tidewire.session import Session
from tidewire.sources import binary_table
from tidewire.sources.remote import Connection
from tidewire.streaming import subscription, windows
from tidewire.wire import make_message, read_message, zip_table


def test_all_types_round_trip(spark):
    spark.conf.set("spark.sql.timeType.enabled", "true")
    rows = [(True, 1, 2, 3, 1.5, 2.5, "x", b"0123456789abcdef", dt.datetime(2024, 1, 2, 3, 4, 5, 678901), dt.date(1999, 12, 31), dt.timedelta(days=-1, microseconds=7), [1, None, 3], ["a", ""]), (False, *[None] * 5, "", b"\0" * 16, None, None, None, [], [])]
    kind = T.StructType([T.StructField(n, t) for n, t in zip("abcdefghijklm", (T.BooleanType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(), T.StringType(), T.BinaryType(), T.TimestampNTZType(), T.DateType(), T.DayTimeIntervalType(), T.ArrayType(T.LongType()), T.ArrayType(T.StringType())))])
    df = spark.createDataFrame(rows, kind)
    assert sorted(map(str, tables.roundtrip(df).collect())) == sorted(map(str, df.collect()))


def test_schema_mismatch_fails(spark):
    m = tables.encode_messages(spark.range(3))
    with pytest.raises(Exception, match="without|column"):
        tables.decode_messages(m, T.StructType([T.StructField("other", T.LongType())])).collect()
    got = tables.infer_schema(m)
    assert got["id"].dataType == T.LongType() and got["id"].metadata == {"ktype": 7}


def test_file_source(spark, tmp_path):
    binary_table.register(spark)
    t = pa.table({"sym": pa.array(["a", "b"]).dictionary_encode(), "at": pa.array([1, -1], pa.timestamp("ns")), "n": pa.array([1, None])})
    for name, block in (("one", None), ("two", 16)):
        (tmp_path / name).write_bytes(zip_table(t, block))
    df = spark.read.format("tidewire").load(str(tmp_path))
    assert df.count() == 4 and df.rdd.getNumPartitions() == 2
    assert {r["at"] for r in df.collect()} == {dt.datetime(1970, 1, 1), dt.datetime(1969, 12, 31, 23, 59, 59, 999999)}
    nanos = spark.read.format("tidewire").option("temporal", "nanos").load(str(tmp_path / "on*"))
    assert sorted(r["at"] for r in nanos.collect()) == [-1, 1]
    out = str(tmp_path / "out")
    df.write.format("tidewire").option("block", "16").mode("append").save(out)
    assert sorted(map(str, spark.read.format("tidewire").load(out).collect())) == sorted(map(str, df.collect()))
    with pytest.raises(Exception, match="no such file"):
        spark.read.format("tidewire").load(str(tmp_path / "none")).collect()


def test_file_writes(spark, tmp_path):
    binary_table.register(spark)
    out = str(tmp_path / "out")
    save = lambda df, mode: df.write.format("tidewire").option("rows", "10").mode(mode).save(out)
    shown = lambda: [p.name for p in (tmp_path / "out").iterdir() if p.name[0] != "."]
    save(spark.range(0, 25, 1, 2), "append")
    assert len(shown()) == 4
    save(spark.range(100, 103, 1, 1), "append")
    load = lambda: sorted(r["id"] for r in spark.read.format("tidewire").load(out).collect())
    assert load() == [*range(25), 100, 101, 102]
    save(spark.range(7), "overwrite")
    assert load() == list(range(7))
    with pytest.raises(Exception, match="ZERO|zero"):
        save(spark.range(40).select(F.expr("if(id < 39, id, 1 div (id - id))").alias("id")), "append")
    assert load() == list(range(7))  # a hidden file of a task that outlived the failure isn't read
    save(spark.range(0), "overwrite")
    assert load() == [] and spark.read.format("tidewire").load(out).schema["id"].dataType == T.LongType()


def test_session(spark):
    s = Session(spark)
    t = spark.createDataFrame([(1, "a", 5), (2, "b", 7), (3, "a", 5)], "i int, sym string, date int")
    s.put("trade", t, ordinal="i")
    assert {r["i"] for r in s.sync("select from trade where date=last date").collect()} == {1, 3}
    assert s.sync("0#trade").count() == 0 and s.sync("0#trade").schema == t.schema
    s.asyn("upsert", "trade", t.limit(1))
    assert s.sync("trade").count() == 4
    s.put("keyed", t, keys=("sym",))
    s.sync("upsert", "keyed", spark.createDataFrame([(9, "a", 1)], t.schema))
    assert {(r["i"], r["sym"]) for r in s.sync("keyed").collect()} == {(9, "a"), (2, "b")}
    assert s.sync("SELECT count(*) AS n FROM trade").first()["n"] == 4
    assert s.sync("copy: trade") is None and s.sync("copy").count() == 4
    assert isinstance(s.sync(".z.p"), dt.datetime)
    s.register("{x+y}", lambda x, y: x + y)
    assert s.sync("{x+y}", 1, 2) == 3
    for text, args in (("1+`a", ()), ("nothing", (1,)), ("upsert", tuple(range(9)))):
        with pytest.raises(CallError):
            s.sync(text, *args)
    with pytest.raises(RemoteError):
        s.sync("SELECT * FROM no_such_table")


def test_matches(spark):
    a = qexpr.til(spark, 5, "i").withColumn("x", F.col("i") * 2)
    assert qexpr.matches(a, a.orderBy(F.desc("i")), "i")
    assert not qexpr.matches(a, a.withColumn("x", F.when(F.col("i") != 3, F.col("x"))), "i")
    assert not qexpr.matches(a, a.withColumn("x", F.col("x").cast("int")), "i")


@pytest.mark.parametrize("salt", [None, 10])
def test_asof(spark, salt):
    left = spark.createDataFrame([(1, "a", 5), (2, "a", 100), (3, "b", 1), (4, "a", 4)], "i int, k string, s int").withColumn("t", F.timestamp_seconds("s"))
    right = spark.createDataFrame([("a", 5, 50), ("a", 7, 70), ("b", 2, 20)], "k string, s int, v int").withColumn("t", F.timestamp_seconds("s"))
    got = relational.asof_join(left, right, "t", ["k"], ["v"], salt_seconds=salt)
    assert {(r["i"], r["v"]) for r in got.collect()} == {(1, 50), (2, 70), (3, None), (4, None)}


def test_stream(spark, tmp_path):
    schema = T.StructType([T.StructField("sym", T.StringType()), T.StructField("price", T.LongType())])

    class Pushed:
        todo = [("upd", "trade", pa.table({"sym": ["a", "b"], "price": [1, 2]})), ("other",), ("upd", "trade", pa.table({"sym": ["a"], "price": [3]}))]

        def receive(self):
            return self.todo.pop(0)

    assert subscription.listen(Pushed(), str(tmp_path / "log"), lambda n: n == 2) == 2
    stream = subscription.updates(spark, str(tmp_path / "log"), "trade", schema, ["a"])
    q = stream.writeStream.format("memory").queryName("got").option("checkpointLocation", str(tmp_path / "c1")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert sorted(r["price"] for r in spark.table("got").collect()) == [1, 3]
    sent = []
    q = subscription.publish(stream, lambda f, t, m: sent.append((f, t, read_message(m).num_rows)), "trade", str(tmp_path / "c2")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert sum(n for _, _, n in sent) == 2 and {s[:2] for s in sent} == {("upsert", "trade")}


def test_stream_windows(spark, tmp_path):
    rows = lambda *s: spark.createDataFrame([(k, t) for k, t in s], "k string, t int").select("k", F.timestamp_seconds("t").cast("timestamp_ntz").alias("ts"))
    first, second = rows(("a", 10), ("a", 70), ("b", 15), ("a", 4000)), rows(("a", 5), ("b", 3950))
    assert {tuple(r) for r in windows.counts(first, F.window("ts", "1 minute"), "k").collect()} == {("a", 0, 60_000_000, 1), ("a", 60_000_000, 120_000_000, 1), ("b", 0, 60_000_000, 1), ("a", 3_960_000_000, 4_020_000_000, 1)}
    assert {tuple(r)[1:] for r in windows.counts(first.filter("k = 'a'"), F.session_window("ts", "90 seconds"), "k").collect()} == {(10_000_000, 160_000_000, 2), (4_000_000_000, 4_090_000_000, 1)}
    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema(first.schema).parquet(str(tmp_path / "in"))
    for part in (first, second, rows(("c", 9000))):
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        q = windows.counts(stream, F.window("ts", "1 minute"), "k", late="10 minutes").writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        q.awaitTermination(120)
    # The row at 5 s came after the watermark had passed its window; the one at 3950 s had not.
    got = {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).select("k", "start_us", "n").collect()}
    assert got == {("a", 0, 1), ("a", 60_000_000, 1), ("b", 0, 1), ("a", 3_960_000_000, 1), ("b", 3_900_000_000, 1)}


class Peer:
    """A stub that answers each call with the next of its replies; a reply may be several messages."""

    def __init__(self, replies, greeting=b"\x06", context=None, linger=0):
        self.server, self.seen, self.modes, self.replies, self.greeting = socket.create_server(("127.0.0.1", 0)), [], [], list(replies), greeting
        self.context, self.linger = context, linger
        self.port = self.server.getsockname()[1]
        threading.Thread(target=self.run, daemon=True).start()

    def run(self):
        c, _ = self.server.accept()
        if self.context:
            try:
                c = self.context.wrap_socket(c, server_side=True)
            except OSError:
                return
        self.hello = c.recv(1024)
        c.sendall(self.greeting)
        while self.greeting and self.replies:
            head = b""
            while len(head) < 8:
                if not (got := c.recv(8 - len(head))):
                    return
                head += got
            size, body = struct.unpack("<I", head[4:])[0] - 8, b""
            while len(body) < size:
                body += c.recv(size - len(body))
            self.seen.append((head[1], body))
            self.modes.append((head[2], size + 8))
            c.sendall(self.replies.pop(0))
        time.sleep(self.linger)
        c.close()


def test_client():
    table = pa.table({"a": [1, 2]})
    peer = Peer([make_message("async", False, ["upd", "t", table]) + make_message("response", True, table), make_message("response", False, 7), b"", struct.pack("<BBBBI", 1, 2, 0, 0, 14) + b"\x80type\0"])
    with Connection("127.0.0.1", peer.port, "me", "pw") as c:
        assert c.sync("t").to_pydict() == {"a": [1, 2]}
        assert c.receive()[:2] == ("upd", "t")
        assert c.sync("{x+y}", 3, 4) == 7
        c.asyn("f", "x")
        with pytest.raises(RemoteError, match="type"):
            c.sync("1+`a")
        with pytest.raises(CallError):
            c.sync("f", *range(9))
    assert peer.hello == b"me:pw\x06\0"
    assert [k for k, _ in peer.seen] == [1, 1, 0, 1]
    assert peer.seen[1][1].startswith(b"\0\0\3\0\0\0\x64\0\x0a\0")
    with pytest.raises(ConnectionFailed):
        Connection("127.0.0.1", 1, timeout=1).sync("x")
    with pytest.raises(AuthFailed):
        Connection("127.0.0.1", Peer([], greeting=b"").port).connect()
    with pytest.raises(ConnectionFailed):
        Connection().disconnect()


class Desk:
    """A stub that takes any number of connections: tables by name, and upserts kept."""

    def __init__(self, tables):
        self.server, self.tables, self.got = socket.create_server(("127.0.0.1", 0)), tables, []
        self.port = self.server.getsockname()[1]
        threading.Thread(target=self.run, daemon=True).start()

    def run(self):
        while True:
            c, _ = self.server.accept()
            threading.Thread(target=self.serve, args=(c,), daemon=True).start()

    def serve(self, c):
        c.recv(1024)
        c.sendall(b"\x06")
        stream = c.makefile("rb")
        while len(head := stream.read(8)) == 8:
            got = read_message(head + stream.read(struct.unpack("<I", head[4:])[0] - 8))
            if isinstance(got, str):
                c.sendall(make_message("response", False, self.tables[got]))
            else:
                self.got.append(got)
                if head[1] == 1:
                    c.sendall(make_message("response", False, got[1]))


def test_remote_tables(spark, tmp_path):
    binary_table.register(spark)
    desk = Desk({"a": pa.table({"id": [1, 2]}), "b": pa.table({"id": [3]}), "c": pa.table({"x": ["?"]}), "n": 7})
    read = lambda **o: spark.read.format("tidewire-remote").options(port=desk.port, **o).load()
    both = read(queries='["a", "b"]')
    assert both.rdd.getNumPartitions() == 2 and sorted(r["id"] for r in both.collect()) == [1, 2, 3]
    assert [r["id"] for r in read(query="b").collect()] == [3]
    for bad in ({"queries": '["a", "c"]'}, {"query": "n"}, {}):
        with pytest.raises(Exception, match="without|didn't return a table|needs the option"):
            read(**bad).collect()
    out = spark.range(0, 10, 1, 2).write.format("tidewire-remote").option("port", desk.port).option("table", "t").option("rows", 3)
    out.mode("append").save()
    assert {g[:2] for g in desk.got} == {("upsert", "t")} and all(g[2].num_rows <= 3 for g in desk.got)
    assert sorted(v for g in desk.got for v in g[2]["id"].to_pylist()) == list(range(10))
    with pytest.raises(Exception, match="appended"):
        out.mode("overwrite").save()
    desk.got.clear()
    spark.range(5).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id long").parquet(str(tmp_path / "in"))
    q = subscription.publish_to(stream, "t", str(tmp_path / "c"), port=str(desk.port)).trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert sorted(v for g in desk.got for v in g[2]["id"].to_pylist()) == list(range(5))


def certificate(tmp_path):
    """A TLS context of a server on localhost, and one of a client that trusts it."""
    import shutil
    import ssl
    import subprocess

    if not shutil.which("openssl"):
        pytest.skip("there is no openssl to make a certificate")
    key, cert = str(tmp_path / "key.pem"), str(tmp_path / "cert.pem")
    made = subprocess.run(["openssl", "req", "-x509", "-newkey", "rsa:2048", "-nodes", "-keyout", key, "-out", cert, "-days", "2", "-subj", "/CN=localhost", "-addext", "subjectAltName=DNS:localhost,IP:127.0.0.1"], capture_output=True)
    assert made.returncode == 0, made.stderr
    server, client = ssl.SSLContext(ssl.PROTOCOL_TLS_SERVER), ssl.create_default_context(cafile=cert)
    server.load_cert_chain(cert, key)
    return server, client


def test_tls(tmp_path):
    server, client = certificate(tmp_path)
    peer = Peer([make_message("response", False, pa.table({"a": list(range(200000))}))], context=server, linger=2)
    with Connection("127.0.0.1", peer.port, "me", "pw", tls=client) as c:
        assert c.sync("t")["a"].to_pylist()[-1] == 199999 and not c.ready(0.01)
    assert peer.hello == b"me:pw\x06\0"
    with pytest.raises(ConnectionFailed):  # a certificate that nobody vouches for
        Connection("127.0.0.1", Peer([b""], context=server).port, tls=True).connect()


def test_large_remote_calls_are_compressed(monkeypatch):
    from tidewire.sources import remote

    monkeypatch.setattr(remote, "COMPRESS_FROM", 5000)
    for local in (True, False):
        peer = Peer([make_message("response", False, 1)] * 3)
        c = Connection("127.0.0.1", peer.port, "me")
        monkeypatch.setattr(Connection, "is_local", local)
        for args in ((pa.table({"a": [7] * 2000}),), (pa.table({"a": [7] * 9}),), ()):
            c.sync("f" if args else "x" * 9000, *args)
        c.disconnect()
        # Large calls with arguments alone, and only to other machines.
        assert [m for m, _ in peer.modes] == [0 if local else 1, 0, 0]
        assert read_message(struct.pack("<BBBBI", 1, 1, peer.modes[0][0], 0, peer.modes[0][1]) + peer.seen[0][1])[1].num_rows == 2000


def test_frames_as_arguments_and_results(spark):
    import pandas as pd

    frame = pd.DataFrame({"s": ["a", "b"], "n": [1, 2]}, index=[5, 6])
    peer = Peer([make_message("response", False, 0)] * 2)
    with Connection("127.0.0.1", peer.port, "me") as c:
        c.sync("upsert", "t", frame)
        c.sync("upsert", "t", spark.createDataFrame(frame))
    for _, body in peer.seen:
        name, table, rows = read_message(struct.pack("<BBBBI", 1, 1, 0, 0, len(body) + 8) + body)
        assert (name, table, rows.to_pydict()) == ("upsert", "t", {"s": ["a", "b"], "n": [1, 2]})
    desk = Desk({"a": pa.table({"id": [1, 2]}), "b": pa.table({"id": [3]})})
    with Connection("127.0.0.1", desk.port, "me") as c:
        both = c.frame(spark, "a", "b")
        assert both.rdd.getNumPartitions() == 2 and sorted(r["id"] for r in both.collect()) == [1, 2, 3]


def test_pushes_beyond_the_bound_fail_the_call():
    push = make_message("async", False, ["upd", "t", pa.table({"a": [1] * 100})])
    peer = Peer([push * 20 + make_message("response", False, 7)])
    with Connection("127.0.0.1", peer.port, "me", most_pushed=5000) as c, pytest.raises(CallError, match="pushed"):
        c.sync("t")


def test_live_stream(spark, tmp_path):
    push = lambda ids: make_message("async", False, ["upd", "t", pa.table({"id": ids, "x": ["?"] * len(ids)})])
    peer = Peer([make_message("response", False, 0) + push([1, 2]) + make_message("async", False, ["upd", "other", pa.table({"id": [9]})]) + push([3]) + push([4])], linger=20)
    rows = subscription.live(spark, "t", T.StructType([T.StructField("id", T.LongType())]), ["a"], port=str(peer.port), user="me", wait="0.2", messages="2")
    q = rows.writeStream.format("memory").queryName("pushed").option("checkpointLocation", str(tmp_path / "c")).start()
    try:
        for _ in range(100):
            if spark.table("pushed").count() >= 4:
                break
            q.awaitTermination(0.3)
        assert sorted(r["id"] for r in spark.table("pushed").collect()) == [1, 2, 3, 4]
    finally:
        q.stop()
    assert read_message(struct.pack("<BBBBI", 1, 1, 0, 0, len(peer.seen[0][1]) + 8) + peer.seen[0][1])[0] == ".u.sub"


def test_readers_pass_over_other_columns(spark, tmp_path):
    binary_table.register(spark)
    t = pa.table({"s": pa.array(["a", "bcd"]), "sym": pa.array(["a", "b"]).dictionary_encode(), "v": pa.array([[1.0], [2.0, 3.0]]), "w": pa.array([[1, 2], [3, 4]]), "g": pa.array([["x", "yz"], []]), "n": pa.array([1, 2]), "b": pa.array([True, False])})
    (tmp_path / "f").write_bytes(zip_table(t, 16))
    for name, kind in (("n", "long"), ("s", "string"), ("b", "boolean"), ("v", "array<double>")):
        got = spark.read.format("tidewire").schema(f"{name} {kind}").load(str(tmp_path / "f")).collect()
        assert [r[0] for r in got] == t[name].to_pylist()
    with pytest.raises(Exception, match="without"):
        spark.read.format("tidewire").schema("missing long").load(str(tmp_path / "f")).collect()


def test_other_formats_feed_the_wire(spark, tmp_path):
    """Spark's own sources on either side of table files."""
    binary_table.register(spark)
    df = spark.read.parquet(f"{SMALL}/nation.parquet").select("n_nationkey", "n_name")
    want = sorted(map(tuple, df.collect()))
    for kind in ("csv", "json", "orc", "parquet"):
        df.write.format(kind).save(str(tmp_path / kind))
        spark.read.schema(df.schema).format(kind).load(str(tmp_path / kind)).write.format("tidewire").mode("append").save(str(tmp_path / f"{kind}-table"))
        assert sorted(map(tuple, spark.read.format("tidewire").load(str(tmp_path / f"{kind}-table")).collect())) == want


def test_upserts_cut_their_plan(spark):
    s = Session(spark)
    s.put("kept", spark.createDataFrame([(0, 0)], "k long, v long"), keys=("k",))
    for i in range(20):
        s.sync("upsert", "kept", spark.createDataFrame([(i % 5, i)], "k long, v long"))
    assert sorted(map(tuple, s.table("kept").collect())) == [(k, 15 + k) for k in range(5)]
    assert s.table("kept")._jdf.queryExecution().analyzed().toString().count("Join") <= 8


def test_entry_imports_without_a_session():
    import subprocess
    import sys

    from conftest import HERE

    got = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()) >= len(e.oracle_sql()) > 60)"], cwd=HERE, capture_output=True, text=True)
    assert got.stdout.strip() == "True", got.stderr


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_queries_match_sql(spark):
    import duckdb

    from tidewire.plans.queries import QUERIES, SQL

    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    plain = lambda v: float(f"{v:.9g}") if isinstance(v, float) else str(v)
    for name, f in QUERIES.items():
        df = f(spark, SMALL)
        want = con.sql(SQL[name])
        cols = sorted(df.columns)
        assert sorted(want.columns) == cols, name
        at = [want.columns.index(c) for c in cols]
        assert sorted(str([plain(r[c]) for c in cols]) for r in df.collect()) == sorted(str([plain(r[i]) for i in at]) for r in want.fetchall()), name


def test_clocks_beyond_32_bits(spark, tmp_path):
    import duckdb

    from tidewire.functions import rules
    from tidewire.plans.queries import QUERIES, SQL

    keys = [0, 9, 10, 873, 874, 21483, 21484, 21485, 119_999, 1_199_999, 60_000_000_000]
    spark.createDataFrame([(k,) for k in keys], "p_partkey long").write.parquet(f"{tmp_path}/part.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW part AS SELECT * FROM '{tmp_path}/part.parquet/*.parquet'")
    want = sorted(con.sql(SQL["time_clamp"]).fetchall())
    assert len(want) == len(keys) and sorted(tuple(r) for r in QUERIES["time_clamp"](spark, str(tmp_path)).collect()) == want

    # the ends of an int and of a long, the null, and around each kind's day
    last = 86_399_999_999
    for kind, day, unit in (("minute", 1440, 60_000_000), ("second", 86_400, 1_000_000), ("time", 86_400_000, 1000)):
        want = {-(1 << 63): 0, -(1 << 31): None, -(1 << 31) + 1: 0, -1: 0, 0: 0, 1: unit, day - 1: (day - 1) * unit, day: last, day + 1: last, (1 << 31) - 1: last, (1 << 63) - 1: last}
        raw = spark.createDataFrame([(k,) for k in want], "raw long")
        assert {r.raw: r.us for r in raw.select("raw", rules.clock_us(F.col("raw"), kind).alias("us")).collect()} == want
        ints = raw.where("raw BETWEEN -2147483648 AND 2147483647").select("raw", rules.clock_us(F.col("raw").cast("int"), kind).alias("us")).collect()
        assert len(ints) == len(want) - 2 and all(want[r.raw] == r.us for r in ints)
