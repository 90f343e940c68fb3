import json
import random

import pytest

from civiclake.sources import files, geojson


def collection(rng, n):
    features = []
    for i in range(n):
        text = "".join(rng.choice('ab{}[]",:\\ é\n\t') for _ in range(rng.randrange(30)))
        geometry = {"type": "Point", "coordinates": [i, [i, {"x": text}]]} if rng.random() < 0.8 else None
        features.append({"type": "Feature", "properties": {"id": i, "t": text, "features": []}, "geometry": geometry})
    return features


def spellings(features, rng):
    body = {"type": "FeatureCollection", "features": features}
    yield json.dumps(body)
    yield json.dumps(body, indent=3, ensure_ascii=False)
    yield json.dumps(body, separators=(",", ":"))
    yield json.dumps({"name": 'a "features": [ {', "crs": {"features": [{"no": [1]}]}, "bbox": [[1], 2], **body, "links": [{"rel": "}"}]})
    yield " \n" + json.dumps(body).replace('"features": [', '"features"' + " " * 700 + ":" + "\n" * 700 + "[", 1) + "\n\n"


@pytest.mark.parametrize("size", [1, 7, 50, 333, 4096])
def test_every_range_gives_its_features(spark, tmp_path, size, monkeypatch):
    rng = random.Random(size)
    monkeypatch.setattr(geojson, "BLOCK", rng.choice([1, 5, 64, 1 << 20]))
    features = collection(rng, 1 + 400 // (400 // size if size < 400 else 1) if size < 50 else 60)[: max(3, min(60, size * 2))]
    for i, text in enumerate(spellings(features, rng)):
        path = tmp_path / f"f{i}.json"
        path.write_text(text)
        length = len(text.encode())
        ranges = [(at, min(at + size, length)) for at in range(0, length, size)]
        place, got, opens, over = geojson.Place(), [], None, False
        for start, end in ranges:
            toggles, depth, least = geojson.summed_up(str(f"file:{path}"), start, end)
            case = int(place.inside)
            here = (place.depth, place.inside)
            if place.depth + least[case] <= 1:
                lists, ends, _ = geojson.members(f"file:{path}", start, end, *here)
                opens = lists[0] if opens is None and lists else opens
            if opens is not None and opens < end and not over:
                got += [json.loads(f) for f in geojson.read_range(f"file:{path}", start, end, length, geojson.Place(*here), opens)]
                over = opens < start and place.depth + least[case] <= 1
            place = geojson.Place(place.depth + depth[case], place.inside != toggles)
        assert (place.depth, place.inside) == (0, False)
        assert got == features


def plain(df):
    """Rows with coordinates as values, as their text may keep its blanks or not."""
    return sorted(((r.id, r.t, r.geometry and (r.geometry.type, json.loads(r.geometry.coordinates))) for r in df.collect()), key=repr)


def test_one_file_is_read_by_several_tasks(spark, tmp_path):
    rng = random.Random(1)
    features = collection(rng, 200)
    for i, text in enumerate(spellings(features, rng)):
        path = tmp_path / f"c{i}.json"
        path.write_text(text)
        whole = files.read_geojson(spark, str(path), "id bigint, t string", "document")
        cut = files.read_geojson(spark, str(path), "id bigint, t string", "document", split_bytes=1000)
        assert cut.rdd.getNumPartitions() > 10
        assert plain(cut) == plain(whole) and cut.count() == 200
    both = files.read_geojson(spark, str(tmp_path), "id bigint, t string", "document", split_bytes=30_000)
    assert both.count() == 1000


def test_files_that_are_no_collection(spark, tmp_path):
    def read(text):
        path = tmp_path / "x.json"
        path.write_text(text)
        return files.read_geojson(spark, str(path), "id bigint", "document", split_bytes=10).collect()

    assert read('{"type": "FeatureCollection", "features": []}') == []
    assert read('{"type": "Feature", "properties": {"id": 1, "features": [{}]}}') == []
    for text in ('{"features": [{"properties": {"id": 1}}]', '{"features": [{"properties": {"id": "1}}]}'):
        with pytest.raises(ValueError, match="not a well-formed"):
            read(text)
    with pytest.raises(ValueError, match="more than one"):
        read('{"features": [{"properties": {"id": 1}}]}\n{"features": []}')
    with pytest.raises(Exception, match="(?i)malformed"):
        read('{"features": [{"properties": {"id": nonsense}}]}')


def test_compressed_and_small_files_are_read_whole(spark, tmp_path):
    import gzip

    text = json.dumps({"features": [{"properties": {"id": i}, "geometry": None} for i in range(50)]})
    (tmp_path / "a.json.gz").write_bytes(gzip.compress(text.encode()))
    (tmp_path / "b.json").write_text(text)
    got = files.read_geojson(spark, str(tmp_path), "id bigint", "document", split_bytes=100)
    assert sorted(r.id for r in got.collect()) == sorted(2 * list(range(50)))
