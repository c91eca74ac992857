"""The log of published runs under racing publishers."""

import threading

import pytest

from arcash.plans import commits
from arcash.plans import publish as P

from tests.helpers import rows


def race(*calls):
    """Run the calls at once; their results or exceptions, in order."""
    out, start = [None] * len(calls), threading.Barrier(len(calls))

    def one(i):
        start.wait()
        try:
            out[i] = calls[i]()
        except Exception as e:
            out[i] = e
    threads = [threading.Thread(target=one, args=(i,)) for i in range(len(calls))]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    return out


def fact(spark, n):
    return {"FactInvoice": spark.range(n).selectExpr("cast(id as int) invoice_id", "cast(1 as decimal(18,2)) amount_incl_gst")}


def test_put_if_absent_has_one_winner(spark, tmp_path):
    for k in range(10):
        path = str(tmp_path / "log" / f"{k}.json")
        got = race(*[lambda i=i: commits.put_if_absent(spark, path, f"writer {i}" * 50) for i in range(6)])
        assert sorted(got) == [False] * 5 + [True]
        assert commits.read_text(spark, path) == f"writer {got.index(True)}" * 50
    assert sorted(p.name for p in (tmp_path / "log").iterdir()) == sorted(f"{k}.json" for k in range(10))


def test_of_two_racing_publishers_one_fails_clean(spark, tmp_path):
    base = str(tmp_path / "pub")
    P.publish(spark, fact(spark, 1), base, "first")
    got = race(*[lambda n=n: P.publish(spark, fact(spark, n), base, f"r{n}", based_on=1) for n in (2, 3)])
    lost = [g for g in got if isinstance(g, P.PublishConflict)]
    won = 2 + next(i for i, g in enumerate(got) if isinstance(g, str))
    assert len(lost) == 1 and f"r{won}" in str(lost[0])
    assert P.current_run(spark, base) == f"r{won}" and P.current_version(spark, base) == 2
    assert P.read_published(spark, base)["FactInvoice"].count() == won
    assert sorted(p.name for p in (tmp_path / "pub").iterdir()) == ["_log", "run_id=first", f"run_id=r{won}"]
    # the one that lost starts again from the present version
    P.publish(spark, fact(spark, 9), base, f"r{5 - won}")
    assert P.current_version(spark, base) == 3 and P.read_published(spark, base)["FactInvoice"].count() == 9
    assert P.read_published(spark, base, "first")["FactInvoice"].count() == 1


def test_racing_publishers_of_one_run_id_do_not_mix(spark, tmp_path):
    base = str(tmp_path / "pub")
    got = race(*[lambda n=n: P.publish(spark, fact(spark, n), base, "same") for n in (4, 7)])
    won = [n for n, g in zip((4, 7), got) if isinstance(g, str)]
    kept = P.read_published(spark, base)["FactInvoice"].count()
    # both are committed if one had ended before the other read the version
    assert len(won) in (1, 2) and kept in won and P.current_version(spark, base) == len(won)


def test_a_run_id_used_again_leaves_open_readers_alone(spark, tmp_path):
    base = str(tmp_path / "pub")
    one = P.publish(spark, fact(spark, 3), base, "r")
    held = P.read_published(spark, base)["FactInvoice"]
    two = P.publish(spark, fact(spark, 5), base, "r", fmt="csv")
    assert one != two and held.count() == 3
    assert P.read_published(spark, base)["FactInvoice"].count() == 5 == P.read_published(spark, base, "r")["FactInvoice"].count()
    assert {r[1] for r in rows(P.stored_metrics(spark, base, "r"), "metric", "value") if r[0] == "rows.FactInvoice"} == {5}


def test_a_run_that_breaks_off_changes_nothing(spark, tmp_path):
    base = str(tmp_path / "pub")
    P.publish(spark, fact(spark, 3), base, "good")
    broken = {"FactInvoice": fact(spark, 3)["FactInvoice"].selectExpr("invoice_id", "cast(raise_error('stop') as decimal(18,2)) amount_incl_gst")}
    with pytest.raises(Exception, match="stop"):
        P.publish(spark, broken, base, "bad")
    (tmp_path / "pub" / "_log" / ".00000002.json.half").write_text('{"run_id": "ba')
    assert P.current_run(spark, base) == "good" and P.read_published(spark, base)["FactInvoice"].count() == 3
    P.publish(spark, fact(spark, 6), base, "bad")
    assert P.read_published(spark, base, "bad")["FactInvoice"].count() == 6


def test_a_base_with_only_a_pointer_goes_on_with_a_log(spark, tmp_path):
    base = str(tmp_path / "pub")
    P.export_tables(fact(spark, 2), f"{base}/run_id=old")
    P.write_text(spark, f"{base}/{P.POINTER}", "old")
    report = {"compare_with_previous": None}
    P.publish(spark, fact(spark, 4), base, "new", report=report)
    assert [(r["previous"], r["current"]) for r in report["compare_with_previous"] if r["kind"] == "count"] == [(2, 4)]
    assert P.current_run(spark, base) == "new" and P.read_published(spark, base, "old")["FactInvoice"].count() == 2


def test_rename_without_overwrite_is_the_way_of_other_stores(spark, tmp_path):
    """viewfs stands for a store without hard links: its files reach this folder through a mount."""
    conf = spark._jsc.hadoopConfiguration()
    (tmp_path / "store").mkdir()
    conf.set("fs.viewfs.mounttable.arcash.link./pub", f"file://{tmp_path}/store")
    path = "viewfs://arcash/pub/log/1.json"
    assert [commits.put_if_absent(spark, path, t) for t in ("a", "b")] == [True, False]
    assert commits.read_text(spark, path) == "a"
    assert [p.name for p in (tmp_path / "store" / "log").iterdir() if not p.name.endswith(".crc")] == ["1.json"]
