import json

from parallax.streaming import intake


def put(folder, key, reader, titles, at=1.0):
    entries = [{"title": t, "printed_page_number": str(10 * (i + 1)), "authors": [], "skip": False} for i, t in enumerate(titles)]
    (folder / f"{key}.{reader}.json").write_text(json.dumps({"generated_at": at, "entries": entries}))


def test_readings_are_gated_as_they_arrive(spark, tmp_path):
    source, folder = tmp_path / "in", str(tmp_path / "state")
    source.mkdir()

    def decided():
        intake.watch(spark, str(source), folder).awaitTermination()
        return {r["key"]: r["reason"] for r in intake.decisions(spark, folder).collect()}

    titles = ["Einleitung", "Methoden", "Ergebnisse"]
    put(source, "one", "a", titles)
    put(source, "one", "b.v2", titles)
    put(source, "two", "a", titles)
    put(source, "none", "a", [])
    assert decided() == {"one": "ok", "two": "single_reading_only", "none": "no_entries"}
    put(source, "two", "b.v2", ["Einleitung", "Anderes", "Ergebnisse"])
    assert decided() == {"one": "ok", "two": "below_threshold", "none": "no_entries"}
    put(source, "two", "c", titles)
    assert decided() == {"one": "ok", "two": "ok", "none": "no_entries"}
    assert decided() == {"one": "ok", "two": "ok", "none": "no_entries"}
