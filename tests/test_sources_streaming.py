import json
import os
import tempfile

from playlens.operators.formatting import format_catalogue_a, format_catalogue_b
from playlens.sources.readers import has_rows, read_raw_json
from playlens.sources.schemas import CATALOGUE_A_SCHEMA, CATALOGUE_B_SCHEMA
from playlens.streaming.loads import consolidate_libraries
from tests.conftest import rows


def _write(path, obj):
    with open(path, "w") as f:
        f.write(obj if isinstance(obj, str) else json.dumps(obj, indent=2))


def test_catalogue_a_from_pretty_json(spark):
    d = tempfile.mkdtemp(prefix="pl-raw-a-")
    recs = [
        {"id": 1, "name": "Foo", "first_release_date": 1704065400, "updated_at": 10,
         "genres": [{"name": "RPG"}], "involved_companies": [
             {"developer": True, "publisher": False, "company": {"name": "Dev"}},
             {"developer": False, "publisher": True, "company": {"name": "Pub"}}],
         "external_games": [{"uid": "x", "external_game_source": {"name": "Other"}},
                            {"uid": "620", "external_game_source": {"name": "Steam"}}],
         "rating": 81.5, "rating_count": 12},
        {"id": 1, "name": "Foo old", "updated_at": 5},
        {"id": "not-a-number", "name": "bad"},
    ]
    _write(os.path.join(d, "page1.json"), recs)
    raw = read_raw_json(spark, os.path.join(d, "*.json"), CATALOGUE_A_SCHEMA)
    out = format_catalogue_a(raw).collect()
    assert len(out) == 1                                  # malformed id dropped, duplicate resolved
    r = out[0]
    assert (r.name, r.developers, r.publishers, r.steam_appid, r.summary, r.hypes) == (
        "Foo", ["Dev"], ["Pub"], 620, "", 0)
    assert r.genre_names == ["RPG"] and r.release_date.year in (2023, 2024)


def test_catalogue_b_lenient_dates(spark):
    d = tempfile.mkdtemp(prefix="pl-raw-b-")
    _write(os.path.join(d, "p.json"), [
        {"id": 7, "name": "Bar", "released": "2024-02-30", "updated": "2024-01-02T03:04:05",
         "added_by_status": {"owned": 3}, "platforms": [{"platform": {"name": "PC"}}],
         "tags": [{"name": "Co-op", "language": "eng"}, {"name": "Koop", "language": "deu"}],
         "stores": [{"store": {"name": "S"}}]}])
    r = format_catalogue_b(read_raw_json(spark, d, CATALOGUE_B_SCHEMA)).first()
    assert r.release_date is None and r.updated_at is not None
    assert (r.platform_names, r.tag_names, r.store_names, r.status_owned, r.metacritic) == (
        ["PC"], ["Co-op"], ["S"], 3, 0)


def test_library_stream_exactly_once(spark):
    src = tempfile.mkdtemp(prefix="pl-lib-src-")
    out, ck = tempfile.mkdtemp(prefix="pl-lib-out-"), tempfile.mkdtemp(prefix="pl-lib-ck-")

    def lib(uid, n):
        return json.dumps({"steam_id": uid, "scraped_at": "2024-01-01T00:00:00",
                           "games": [{"appid": i, "playtime_forever": 1} for i in range(n)]})
    _write(os.path.join(src, "u1.json"), lib("u1", 2))
    _write(os.path.join(src, "u2.json"), lib("u2", 0))          # empty library: filtered
    consolidate_libraries(spark, src, out, ck)
    assert rows(spark.read.parquet(out), "steam_id") == [("u1",)]
    consolidate_libraries(spark, src, out, ck)                  # nothing new: nothing added
    assert spark.read.parquet(out).count() == 1
    _write(os.path.join(src, "u1.json"), lib("u1", 3))          # rewritten under the same name: not re-read
    _write(os.path.join(src, "u3.json"), lib("u3", 1))
    consolidate_libraries(spark, src, out, ck)
    assert rows(spark.read.parquet(out), "steam_id") == [("u1",), ("u3",)]
    assert has_rows(spark.read.parquet(out))
