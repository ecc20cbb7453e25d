import datetime
import json
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

import paperwarden as pw
from paperwarden.operators import profiles

TODAY = datetime.date(2026, 8, 29)
VENDORS = [("Brindle Paper Works", 1600.0, 30), ("Oxbow Cold Storage", 9400.0, 60), ("Tarn Optics", 840.0, 15)]


def invoice_text(vendor="Brindle Paper Works", number="Q7-5001", date="2026-06-10", due="2026-07-10", po="B-88120",
                 subtotal=1500.37, tax=120.03, total=None, note=None):
    total = round(subtotal + tax, 2) if total is None else total
    lines = [vendor, "Goods delivered to dock 4", f"Subtotal {subtotal:,.2f}", f"Tax {tax:,.2f}",
             f"Total amount due {total:,.2f}", f"Due date - {due}", "Payment terms - NET30", f"Invoice date - {date}",
             f"PO # {po}", f"Invoice # {number}"]
    return "\n".join(lines + ([note] if note else []))


LIST = "pallet crate barrel drum sack\n" * 4
DOCUMENTS = {
    "clean": invoice_text(),
    "arithmetic": invoice_text(number="Q7-5002", total=1588.90),
    "due_first": invoice_text(number="Q7-5003", due="2026-05-20"),
    "future": invoice_text(number="Q7-5004", date="2026-11-03", due="2026-12-03"),
    "duplicate": invoice_text(number="Q7-1", subtotal=9000.11, tax=720.01),
    "lookalike": invoice_text(vendor="Brindle Papr Works", number="Q7-5005"),
    "missing": invoice_text(number="", po=""),
    "conflict": invoice_text(number="Q7-5006", note="Booked as paid in full, yet the balance due is 5"),
    "round": invoice_text(number="Q7-5007", subtotal=1500.0, tax=120.0),
    "versions": invoice_text(number="Q7-5008", note="This draft stands in for the final sheet"),
    "unread": invoice_text(number="Q7-5009", date="2026-XX-13"),
    "original": LIST + invoice_text(number="Q7-6001", po="B-1", subtotal=1811.11),
    "resubmitted": LIST + invoice_text(number="Q7-6001-R", po="B-1", subtotal=1811.11),
}
RULES = {
    "clean": [], "arithmetic": [("arithmetic", "high")], "due_first": [("date_logic", "high")],
    "future": [("date_logic", "high")], "duplicate": [("amount_outlier", "high"), ("duplicate", "high")],
    "lookalike": [("vendor_lookalike", "high")], "missing": [("missing_fields", "medium")],
    "conflict": [("conflicting_statement", "high")], "round": [("round_numbers", "low")],
    "versions": [("conflicting_statement", "medium")], "unread": [("date_format", "medium")],
    "original": [], "resubmitted": [],
}


def past_invoices():
    rng = np.random.default_rng(1)
    rows = []
    for number in range(240):
        vendor, mean, days = VENDORS[number % 3]
        day = datetime.date(2024, 1, 2) + datetime.timedelta(days=3 * number)
        subtotal = round(float(mean * rng.normal(1, 0.15)), 2)
        tax = round(subtotal * 0.08, 2)
        rows.append((f"Q7-{number + 1}", vendor, day, day + datetime.timedelta(days=days), f"NET{days}",
                     f"B-{20000 + number}", subtotal, tax, round(subtotal + tax, 2)))
    return rows


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    folder = tmp_path_factory.mktemp("files")
    with open(folder / "history.csv", "w") as out:
        out.write("invoice_number,vendor_name,invoice_date,due_date,payment_terms,po_number,subtotal,tax,total_amount\n")
        out.writelines(",".join(map(str, row)) + "\n" for row in past_invoices())
    docs = folder / "docs"
    docs.mkdir()
    for name, text in DOCUMENTS.items():
        (docs / f"{name}.txt").write_text(text)
    return folder


@pytest.fixture(scope="module")
def history(spark, files):
    return pw.read_history(spark, str(files / "history.csv"))


@pytest.fixture(scope="module")
def model(history):
    return pw.fit(history, trees=60)


@pytest.fixture(scope="module")
def reports(spark, files, model, tmp_path_factory):
    report = model.score(pw.read_documents(spark, str(files / "docs")), TODAY)
    path = str(tmp_path_factory.mktemp("report"))
    pw.write_report(pw.by_risk(report), path)
    return spark.read.json(path), report


def test_rules_and_reasons(reports):
    rows = {r.doc_id.removesuffix(".txt"): r for r in reports[0].collect()}
    assert rows.keys() == DOCUMENTS.keys()
    for name, expected in RULES.items():
        got = [(x.category, x.severity) for x in rows[name].reasons if x.source == "rule"]
        assert got == expected, name
    for a, b in (("original", "resubmitted"), ("resubmitted", "original")):
        partners = [x.message for x in rows[a].reasons if x.source == "similarity"]
        assert len(partners) == 1 and f"'{b}.txt'" in partners[0] and "100% similar" in partners[0]
    assert rows["duplicate"].risk_level == "High" and rows["arithmetic"].risk_level != "Low"
    assert "difference of $31.50" in rows["arithmetic"].reasons[0].message
    assert rows["lookalike"].reasons[0].message.startswith(
        "Vendor name 'Brindle Papr Works' is 97% similar to known vendor 'Brindle Paper Works'")


def test_json_keeps_nulls(reports, spark, files):
    saved, _ = reports
    assert saved.where("extracted_fields.invoice_number is null").count() == 1
    assert {"ml_anomaly_score", "ml_anomaly_percentile", "risk_level"} <= set(saved.columns)


def test_summary_and_order(reports, spark):
    saved, _ = reports
    lines = {r.doc_id: r.summary for r in pw.summary_lines(saved).collect()}
    assert lines["duplicate.txt"].startswith("[ HIGH ] duplicate.txt — ")
    ranks = [{"High": 2, "Medium": 1, "Low": 0}[r.risk_level] for r in pw.by_risk(saved).collect()]
    assert ranks == sorted(ranks, reverse=True)


def test_detection_table(reports, spark, files):
    (files / "labels.csv").write_text("filename,ground_truth_note\n" + "".join(
        f'{n}.txt,"kind, {n}"\n' for n in DOCUMENTS))
    rows = pw.detection_table(reports[0], pw.read_labels(spark, str(files / "labels.csv"))).collect()
    table = {r.ground_truth_note: r.recall for r in rows}
    assert all(table[f"kind, {n}"] == 1.0 for n, flags in RULES.items() if flags)


def test_saved_model_scores_alike(spark, model, files, tmp_path, reports):
    model.save(str(tmp_path / "model"))
    again = pw.DocumentModel.load(spark, str(tmp_path / "model"))
    docs = pw.read_documents(spark, str(files / "docs"))
    first = {r.doc_id: r for r in reports[1].collect()}
    assert {r.doc_id: r for r in again.score(docs, TODAY).collect()} == first


def test_stream_gives_the_batch_report(spark, model, files, tmp_path):
    source = spark.readStream.schema("value string").text(str(files / "docs"), wholetext=True).select(
        F.col("_metadata.file_name").alias("doc_id"), F.col("value").alias("raw_text"))
    query = pw.score_stream(source, model, TODAY, str(tmp_path / "out"), str(tmp_path / "progress"),
                            available_now=True)
    query.awaitTermination(120)
    assert query.exception() is None
    columns = ["doc_id", "risk_level", "ml_anomaly_score"]
    got = spark.read.json(str(tmp_path / "out")).select(columns).collect()
    expected = model.score(pw.read_documents(spark, str(files / "docs")), TODAY, near_duplicates=False)
    assert sorted(got) == sorted(expected.select(columns).collect())


def test_files_and_rejects(spark, tmp_path):
    for name, data in {"a.txt": b"x\r\ny\rz", "B.TXT": b"caf\xc3\xa9 \xff!", "c.pdf": b"%PDF", "d.PNG": b"1", "e.doc": b"2",
                       "noext": b"3", "kept.txt": "a�b".encode()}.items():
        (tmp_path / name).write_bytes(data)
    texts = {r.doc_id: r.raw_text for r in pw.read_documents(spark, str(tmp_path)).collect()}
    assert texts == {"a.txt": "x\ny\nz", "B.TXT": "café !", "kept.txt": "a�b"}
    rejected = {r.path.rsplit("/", 1)[1]: (r.ext, r.reason) for r in pw.read_rejects(spark, str(tmp_path)).collect()}
    assert rejected == {"c.pdf": (".pdf", "needs text recognition"), "d.PNG": (".png", "needs text recognition"),
                        "e.doc": (".doc", "Unsupported file type: .doc"), "noext": ("", "Unsupported file type: ")}
    (tmp_path / "empty").mkdir()
    assert pw.read_documents(spark, str(tmp_path / "empty")).count() == 0


def test_profiles_on_edges(spark):
    day = datetime.date(2025, 1, 6)
    rows = [("1", "one", day, day, "NET30", "p", 1.0, 0.0, 100.0), ("2", "two", day, day, "B7", "p", 1.0, 0.0, 50.0),
            ("3", "two", day, day, "A15", "p", 1.0, 0.0, 50.0), ("4", "two", day, day, None, "p", 1.0, 0.0, 50.0),
            ("5", None, day, day, "X", "p", 1.0, 0.0, 7.0), ("6", "none", day, day, None, "p", 1.0, 0.0, 1.0)]
    past = spark.createDataFrame(rows, pw.sources.history.HISTORY_SCHEMA)
    found = {r.vendor_name: r for r in profiles.vendor_profiles(past).collect()}
    assert found.keys() == {"one", "two", "none"}
    assert found["one"].amount_std is None and found["two"].amount_std == 1e-6
    assert (found["two"].typical_terms, found["two"].typical_net_days) == ("A15", 15)
    assert (found["none"].typical_terms, found["none"].typical_net_days) == (None, None)
    assert profiles.global_profile(past).first().invoice_count == 6


def test_merged_baseline_is_that_of_the_whole_history(spark):
    rng = random.Random(4)
    days = [datetime.date(2025, 1, 1) + datetime.timedelta(days=k) for k in range(300)]
    rows = [(f"N{k}", rng.choice(["Ash", "Beech", "Cedar", None]), rng.choice(days), None, rng.choice(["NET30", "NET15", None]),
             "p", 1.0, 0.0, rng.choice([None, 1e6, 1e6 + rng.random()])) for k in range(400)]
    rows += [("M1", "Alone", days[0], None, None, "p", 1.0, 0.0, 5.0), ("M2", "Same", days[0], None, "X", "p", 1.0, 0.0, 123456.78),
             ("M3", "Same", days[1], None, "Y", "p", 1.0, 0.0, 123456.78), (None, "Same", days[1], None, "Y", "p", 1.0, 0.0, 123456.78)]
    past = spark.createDataFrame(rows, pw.sources.history.HISTORY_SCHEMA)
    half = F.crc32(F.coalesce("invoice_number", F.lit(""))) % 2 == 0
    whole = pw.fit_baseline(past)
    merged = pw.fit_baseline(past.where(half)).merge(pw.fit_baseline(past.where(~half)))
    merged = merged.merge(pw.fit_baseline(past.limit(0)))
    expected = {r.vendor_name: r for r in whole.vendors.collect()}
    found = {r.vendor_name: r for r in merged.vendors.collect()}
    assert found.keys() == expected.keys() == {"Ash", "Beech", "Cedar", "Alone", "Same"}
    for name, row in expected.items():
        assert tuple(found[name])[3:] == tuple(row)[3:]
        assert found[name].amount_mean == pytest.approx(row.amount_mean, rel=1e-9)
        assert (found[name].amount_std is None) == (row.amount_std is None)
        assert found[name].amount_std == pytest.approx(row.amount_std, rel=1e-9) if row.amount_std else name == "Alone"
    values = [r[8] for r in rows if r[1] == "Ash" and r[8] is not None]
    assert expected["Ash"].amount_std == pytest.approx(statistics.stdev(values), rel=1e-9)
    assert expected["Same"].amount_std == 1e-6 and expected["Alone"].amount_std is None
    assert (merged.amount_mean, merged.amount_std) == pytest.approx((whole.amount_mean, whole.amount_std), rel=1e-12)
    assert (merged.latest_date, merged.invoice_count) == (whole.latest_date, 404)
    assert sorted(merged.invoice_numbers.collect()) == sorted(whole.invoice_numbers.collect())


def test_history_is_scanned_once(spark):
    past = spark.createDataFrame([(str(k), "v", None, None, "NET30", "p", 1.0, 0.0, 9.0) for k in range(50)],
                                 pw.sources.history.HISTORY_SCHEMA)
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    pw.fit_baseline(past.mapInArrow(counted, past.schema))
    assert read.value == 50


def test_history_with_broken_rows(spark, tmp_path):
    head = "invoice_number,vendor_name,invoice_date,due_date,payment_terms,po_number,subtotal,tax,total_amount\n"
    (tmp_path / "a.csv").write_text(head + '1,"Ash, Elm & Co",2025-01-02,2025-02-01,NET30,P1,1.5,0.5,2.0\n'
                                    "2,Beech,2025-13-02,2025-02-01,NET30,P1,1,0,1\n3,Cedar,2025-01-02\n"
                                    "4,Dogwood,2025-01-02,,NET30,P1,1,0,1,extra\n005,Elder,,,,,,,\n"
                                    "6,Fir,2025-01-02,2025-02-01,NET30,P1,one,0,two\n")
    good, rejects = pw.read_history_checked(spark, str(tmp_path))
    assert sorted((r.invoice_number, r.vendor_name, r.total_amount) for r in good.collect()) == [
        ("005", "Elder", None), ("1", "Ash, Elm & Co", 2.0)]
    found = {r.line.split(",")[0]: (r.reason, r.path.endswith("a.csv")) for r in rejects.collect()}
    assert found == {"2": ("invoice_date: 2025-13-02", True), "3": ("wrong number of values", True),
                     "4": ("wrong number of values", True), "6": ("subtotal: one", True)}
    with pytest.raises(Exception):
        pw.read_history(spark, str(tmp_path)).collect()
    (tmp_path / "labels.csv").write_text("filename,ground_truth_note\na.txt,fine\nb.txt\n")
    good, rejects = pw.read_labels_checked(spark, str(tmp_path / "labels.csv"))
    assert [tuple(r) for r in good.collect()] == [("a.txt", "fine")] and [r.line for r in rejects.collect()] == ["b.txt"]


def test_batches_replace_themselves(spark, tmp_path):
    def rows(*levels):
        return spark.createDataFrame([(f"d{k}", level) for k, level in enumerate(levels)], "doc_id string, risk_level string")

    path = str(tmp_path / "reports")
    assert pw.write_batch(rows("High", "Low", "Low"), path, 1) == 3
    pw.write_batch(rows("Medium"), path, 2)
    pw.write_batch(rows("Low"), path, 1)
    pw.write_batch(rows().limit(0), path, 3)
    assert sorted((r.batch, r.doc_id, r.risk_level) for r in pw.read_batches(spark, path).collect()) == [
        (1, "d0", "Low"), (2, "d0", "Medium")]
    rows("Low", "Low").write.mode("append").partitionBy("risk_level").parquet(f"{path}/batch=2")
    with pytest.raises(OSError, match="batch 2"):
        pw.read_batches(spark, path)


def test_checks_reach_across_micro_batches(spark, model, tmp_path):
    first = {"a.txt": invoice_text(number="S-1"), "b.txt": invoice_text(vendor="Tarn Optics", number="S-2", subtotal=810.4)}
    second = {"c.txt": invoice_text(number="S-1"), "d.txt": invoice_text(vendor="Oxbow Cold Storage", number="S-9", subtotal=99.9)}
    folder = tmp_path / "docs"
    folder.mkdir()

    def arrive(docs):
        for name, text in docs.items():
            (folder / name).write_text(text)
        source = spark.readStream.schema("value string").text(str(folder), wholetext=True).select(
            F.col("_metadata.file_name").alias("doc_id"), F.col("value").alias("raw_text"))
        query = pw.score_stream(source, model, TODAY, str(tmp_path / "out"), str(tmp_path / "progress"), available_now=True,
                                index=str(tmp_path / "index"))
        query.awaitTermination(180)
        assert query.exception() is None

    def reasons_of(doc):
        row = spark.read.json(str(tmp_path / "out")).where(F.col("doc_id") == doc).first()
        return {r.category for r in row.reasons}

    arrive(first)
    assert not {"duplicate", "near_duplicate"} & reasons_of("a.txt")
    arrive(second)
    assert {"duplicate", "near_duplicate"} <= reasons_of("c.txt")
    assert not {"duplicate", "near_duplicate"} & reasons_of("d.txt")

    from paperwarden.operators import neardup
    from paperwarden.streaming.index import DocumentIndex
    index = DocumentIndex(spark, str(tmp_path / "index"))
    every = spark.createDataFrame([*first.items(), *second.items()], "doc_id string, raw_text string")
    expected = neardup.partner_summary(neardup.find_near_duplicates(every)).collect()
    assert sorted(neardup.partner_summary(index.near_duplicates(1, "string")).collect()) == sorted(expected) != []
    again = spark.createDataFrame(list(second.items()), "doc_id string, raw_text string")
    index.add(1, again, pw.extract_fields(again))
    assert sorted(neardup.partner_summary(index.near_duplicates(1, "string")).collect()) == sorted(expected)


def test_one_scan_of_a_folder(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name, data in {"a.txt": b"x\r\ny", "B.TXT": b"caf\xc3\xa9 \xff!", "c.pdf": b"%PDF", "e.doc": b"2", "noext": b"3"}.items():
        (tmp_path / "in" / name).write_bytes(data)
    files = pw.read_folder(spark, str(tmp_path / "in"))
    texts = {"a.txt": "x\ny", "B.TXT": "café !"}
    reasons = {"c.pdf": "needs text recognition", "e.doc": "Unsupported file type: .doc", "noext": "Unsupported file type: "}
    assert {r.doc_id: r.raw_text for r in pw.documents_of(files).collect()} == texts
    assert {r.doc_id: r.reason for r in files.where("reason is not null").collect()} == reasons
    query = pw.read_folder(spark, str(tmp_path / "in"), stream=True).writeStream.format("memory").queryName(
        "arrived").trigger(availableNow=True).start()
    query.awaitTermination(60)
    arrived = spark.table("arrived")
    assert {r.doc_id: r.raw_text for r in pw.documents_of(arrived).collect()} == texts
    assert arrived.where("reason is not null").count() == 3
    plain = {(r.path.rsplit("/", 1)[1], r.reason) for r in pw.read_rejects(spark, str(tmp_path / "in")).collect()}
    assert plain == set(reasons.items())
