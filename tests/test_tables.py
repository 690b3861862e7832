"""Reading raw loan tables."""

import gzip

from creditloom.sources import tables


def test_line_breaks_in_quoted_text_do_not_split_loans(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    with gzip.open(folder / "accepted.csv.gz", "wt") as out:
        out.write('id,loan_amnt,desc,loan_status\n'
                  '1,1000,"first line\nsecond, ""quoted"" line",Fully Paid\n'
                  '2,2000,plain,Charged Off\n')
    rows = tables.read_raw_csv(spark, str(folder), partitions=2).orderBy("id").collect()
    assert [(r.id, r.loan_amnt, r.desc, r.loan_status, r.loan_id) for r in rows] == [
        ("1", 1000.0, 'first line\nsecond, "quoted" line', "Fully Paid", 1), ("2", 2000.0, "plain", "Charged Off", 2)]


def _file(tmp_path, name, text, packed=False):
    folder = tmp_path / name
    folder.mkdir()
    opener = (lambda p: gzip.open(p, "wt")) if packed else (lambda p: open(p, "w"))
    with opener(folder / ("a.csv.gz" if packed else "a.csv")) as out:
        out.write(text)
    return str(folder)


BROKEN = ('id,loan_amnt,grade,desc\n1,1000,A,fine\n2,much,B,text for a number\n3,3000\n4,4000,D,one,more\n'
          '5,,E,"quoted, with\nbreak"\n,,,\n')


def test_malformed_records_are_kept_apart(spark, tmp_path):
    read = tables.read_raw(spark, _file(tmp_path, "raw", BROKEN, packed=True))
    assert sorted((r.id, r.loan_amnt, r.desc) for r in read.rows.where("id is not null").collect()) == [
        ("1", 1000.0, "fine"), ("5", None, "quoted, with\nbreak")]
    rejects = {r.record.split(",")[0]: r for r in read.rejects.collect()}
    assert {k: r.reason for k, r in rejects.items()} == {"2": "not a number: loan_amnt", "3": "not 4 cells", "4": "not 4 cells"}
    assert rejects["3"].record == "3,3000" and all(r.file.endswith("a.csv.gz") for r in rejects.values())
    assert read.rows.count() + read.rejects.count() == 6


def test_rejects_are_appended(spark, tmp_path):
    path, out = _file(tmp_path, "raw", BROKEN, packed=True), str(tmp_path / "rejects")
    assert tables.read_raw_csv(spark, path, 3, rejects_path=out).count() == 3
    assert tables.read_applications(spark, path, rejects_path=out).count() == 3
    assert spark.read.parquet(out).count() == 6


def test_line_breaks_in_titles_do_not_split_applications(spark, tmp_path):
    path = _file(tmp_path, "apps", 'loan_id,emp_title,dti\n1,"chief\nsenior",10\n2,clerk,5\n')
    got = [(r.loan_id, r.emp_title, r.dti) for r in tables.read_applications(spark, path).orderBy("loan_id").collect()]
    assert got == [(1, "chief\nsenior", 10.0), (2, "clerk", 5.0)]


def test_plain_text_is_read_in_pieces_unless_asked(spark, tmp_path):
    path = _file(tmp_path, "plain", 'id,grade\n1,A\n2,B\n')
    assert not tables._has_gzip(spark, path) and tables.read_raw(spark, path).rows.count() == 2
    assert tables._has_gzip(spark, _file(tmp_path, "packed", "id\n1\n", packed=True))


def test_reports_stay_small(spark, tmp_path):
    import pytest
    tables.write_small_csv(spark.range(5), str(tmp_path / "report"), most=5)
    with pytest.raises(ValueError, match="no report"):
        tables.write_small_csv(spark.range(6), str(tmp_path / "report"), most=5)
