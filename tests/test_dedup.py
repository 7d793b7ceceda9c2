from datetime import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quarterline.sources import files
from quarterline.streaming.dedup import SeenStore, deduplicate_stream, messages, superfluous_copies

T = [datetime(2023, 1, k) for k in range(1, 29)]


def expected(rows):
    best, out = {}, []
    for k, r in enumerate(rows, 1):
        key = (r[0] or "").strip()
        if key:
            rank = (r[5] or datetime.min, -k)
            best.setdefault(key, []).append((rank, k))
    for copies in best.values():
        out += [k for _, k in sorted(copies)[:-1]]
    return sorted(out)


def found(df, **kw):
    return sorted(r["row_id"] for r in superfluous_copies(df, **kw).collect())


def test_choice(bronze):
    rows = [
        ("a", None, None, None, None, T[3], "f-001"), (" a\t", None, None, None, None, T[5], "f-001"), ("a ", None, None, None, None, T[5], "f-002"),
        ("b", None, None, None, None, None, "f-001"), ("b", None, None, None, None, None, "f-009"), ("b", None, None, None, None, T[0], None),
        (None, None, None, None, None, T[0], "f-001"), ("  ", None, None, None, None, T[0], "f-001"), ("  ", None, None, None, None, T[0], "f-001"), ("A", None, None, None, None, T[0], "odd"),
    ]
    assert found(bronze(rows), loads_per_epoch=2) == [1, 3, 4, 5] == expected(rows)


def test_empty(bronze):
    assert found(bronze([])) == []


ROWS = st.lists(st.tuples(st.sampled_from(["a", "b", " a", "c", "", None]), st.none(), st.none(), st.none(), st.none(), st.one_of(st.none(), st.sampled_from([*T, datetime(2019, 1, 1), datetime(2099, 1, 1)])), st.sampled_from(["f-001", "f-002", "g-003", "f-014", None])), min_size=1, max_size=25)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ROWS)
def test_epochs_agree_with_one_pass(bronze, rows):
    assert found(bronze(rows), loads_per_epoch=2) == expected(rows)


def test_copies_after_expiry_are_found_in_the_archive(spark, bronze):
    store = SeenStore(spark, files.scratch(spark, "seen"), expiry_days=30)
    old = [("a", None, None, None, None, datetime(2019, 1, 1)), ("b", None, None, None, None, datetime(2019, 1, 2))]
    rows = [*old, ("x", None, None, None, None, datetime(2023, 1, 1)), ("a", None, None, None, None, datetime(2018, 1, 1)), ("b", None, None, None, None, datetime(2023, 6, 1))]
    df = messages(bronze(rows))
    for number, part in enumerate(("row_id <= 2", "row_id = 3", "row_id = 4", "row_id = 5"), 1):
        store.process(df.where(part), number)
    last = store.last()
    assert last.archive and last.number == 4
    assert sorted(r["row_id"] for r in store.superfluous().collect()) == [2, 4] == expected(rows)
    hot = {r["id"] for p in last.hot for r in spark.read.parquet(p).collect()}
    assert "a" not in hot


def test_a_committed_epoch_is_not_run_again_and_an_uncommitted_one_is(spark, bronze, monkeypatch):
    store = SeenStore(spark, files.scratch(spark, "seen"))
    df = messages(bronze([("a", None, None, None, None, T[0]), ("a", None, None, None, None, T[1])]))
    real = files.write_text
    monkeypatch.setattr(files, "write_text", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    try:
        store.process(df, 1)
    except OSError:
        pass
    assert store.last() is None and store.superfluous().count() == 0
    monkeypatch.setattr(files, "write_text", real)
    store.process(df, 1)
    store.process(df, 1)
    assert [r["row_id"] for r in store.superfluous().collect()] == [1]


def test_stream(spark, bronze, tmp_path):
    rows = [("a", None, None, None, None, T[0]), ("b", None, None, None, None, T[1]), ("a", None, None, None, None, T[2]), ("b", None, None, None, None, T[0])]
    df = bronze(rows)
    df.where("row_id <= 2").coalesce(1).write.parquet(f"{tmp_path}/in/1")
    stream = lambda: spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    store = SeenStore(spark, f"{tmp_path}/state")
    deduplicate_stream(stream(), store, f"{tmp_path}/check").awaitTermination()
    df.where("row_id > 2").coalesce(1).write.parquet(f"{tmp_path}/in/2")
    deduplicate_stream(stream(), store, f"{tmp_path}/check").awaitTermination()
    assert sorted(r["row_id"] for r in store.superfluous().collect()) == expected(rows)


def test_of_two_racing_writers_one_wins_and_nothing_is_lost(spark, bronze, monkeypatch):
    root = files.scratch(spark, "seen")
    one, other = SeenStore(spark, root), SeenStore(spark, root)
    rows = [("a", None, None, None, None, T[0]), ("a", None, None, None, None, T[1]), ("b", None, None, None, None, T[2]), ("b", None, None, None, None, T[1])]
    df = messages(bronze(rows))
    real, raced = files.write_text, []

    def late(*args):
        if not raced:
            raced.append(True)
            assert other.process(df, 1)  # while the first stands before its commit
        return real(*args)

    monkeypatch.setattr(files, "write_text", late)
    assert not one.process(df, 1)
    assert len([n for n in files.names(spark, root) if n.startswith("epoch-")]) == 1
    assert one.last() == other.last() and sorted(r["row_id"] for r in one.superfluous().collect()) == expected(rows)
    assert not one.process(df, 1)


def test_an_epoch_writes_what_arrived_and_no_more(spark, bronze):
    store = SeenStore(spark, files.scratch(spark, "seen"))
    rows = [(str(k), None, None, None, None, T[k % 28]) for k in range(300)] + [("7", None, None, None, None, T[27]), ("new", None, None, None, None, T[3])]
    df = messages(bronze(rows))
    store.process(df.where("row_id <= 300"), 1)
    first = set(store.last().hot)
    store.process(df.where("row_id > 300"), 2)
    assert first < set(store.last().hot)
    added = spark.read.parquet(*(set(store.last().hot) - first))
    assert {r["id"] for r in added.collect()} == {"7", "new"}
    assert [r["row_id"] for r in store.superfluous().collect()] == expected(rows) == [8]
