"""Queries over whole tables: dates in every spelling that the operators read."""

import pytest

from corpusloom.plans import registry

Q = registry.queries()
DAY = 1_577_836_800_000_000  # 2020-01-01
DATES = {
    1: ("2020-01-01", DAY), 2: ("1577836800", DAY), 3: ("2020-01-01T02:00:00+02:00", DAY), 4: ("Wed, 01 Jan 2020 00:00:00 GMT", DAY), 5: ("yesterday", None), 6: (None, None),
    9: ("20211123134215", None), 7: ("1640995200", DAY + 731 * 86_400_000_000), 8: ("Sat, 01 Jan 2022 00:00:00 +0000", DAY + 731 * 86_400_000_000),
}


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    at = f"file://{tmp_path_factory.mktemp('whole')}"
    rows = [(i, f"d{i}", d, d, "8871c275b1e6b365") for i, (d, _) in DATES.items()]
    spark.createDataFrame(rows, "entry_id long, doc_id string, last_updated string, sitemap_lastmod string, config_sig string").write.parquet(f"{at}/manifest.parquet")
    spark.createDataFrame([("d7", "indexed")], "doc_id string, status string").write.parquet(f"{at}/tracker_log.parquet")
    spark.createDataFrame([(i, "a.example", d) for i, (d, _) in DATES.items()], "doc_id long, site string, updated_at string").write.parquet(f"{at}/documents.parquet")
    return at


def rows(spark, made, name):
    return {tuple(r) for r in Q[name](spark, made).collect()}


def test_every_spelling_is_looked_at(spark, made):
    known = {i: us for i, (_, us) in DATES.items()}
    since = DAY + 366 * 86_400_000_000
    assert rows(spark, made, "parsed_instants") == {(i, us) for i, us in known.items() if DATES[i][0] is not None}
    assert rows(spark, made, "modified_documents") == {(f"d{i}", "updated" if i == 7 else "new") for i, us in known.items() if us and us > since}
    assert rows(spark, made, "kept_by_date") == {(i, us is None or us < since + 365 * 86_400_000_000) for i, us in known.items()}
    # listed on 2020-06-01: skipped where what is stored is no older
    assert rows(spark, made, "skipped_before_fetch") == {(i, bool(us and us > DAY + 152 * 86_400_000_000)) for i, us in known.items()}
    assert rows(spark, made, "sitemap_walk") == {(f"https://a.example/{i}", d) for i, (d, _) in DATES.items()}


def test_a_permission_listed_twice_stays_once(spark, tmp_path):
    payload = '{"metadata": {"permissions": [{"id": "p", "type": "user", "role": "reader"}, {"id": "p", "type": "user", "role": "owner"}, {"id": "q", "type": "domain", "role": "reader"}]}}'
    spark.createDataFrame([(1, payload)], "rec_id long, payload string").write.parquet(f"file://{tmp_path}/raw_records.parquet")
    assert rows(spark, f"file://{tmp_path}", "merged_permissions") == {(1, "user", "p", "reader"), (1, "domain", "q", "inherited")}


def test_manifest_of_every_source(spark, tmp_path):
    listed = [(1, "a", "h1", "s"), (2, "a", "h2", "t"), (3, "a", None, "s"), (4, "", "h", "s"), (5, None, "h", "s")]
    spark.createDataFrame(listed, "entry_id long, doc_id string, content_hash string, source string").write.parquet(f"file://{tmp_path}/manifest.parquet")
    assert rows(spark, f"file://{tmp_path}", "manifest_by_id") == {("s", "a", 3, ""), ("t", "a", 2, "h2")}
