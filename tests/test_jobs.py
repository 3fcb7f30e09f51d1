"""End-to-end: every file-to-file job on small files in a fresh folder."""

import json
import os

from ridgeline.plans import jobs
from ridgeline.sources import io


def _write(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


def test_jobs_end_to_end(spark, tmp_out):
    d = tmp_out
    header = "date,country,position,streams,track_id,artists,artist_genres,duration,explicit,name"
    rows = [header]
    tracks = {  # track -> (artists, genres, explicit, name, streams per week)
        "t1": ("['A']", "['dance pop', 'pop']", "true", "One", 100),
        "t2": ("['B']", "['rock']", "false", "Two", 90),
        "t3": ("['C']", "[]", "false", "Three", 80),
        "t4": ("['D', \"E's\"]", "['trap']", "true", "Four", 70),
        "t5": ("['A']", "['pop']", "false", "One", 60),  # same name+artist as t1
    }
    for country in ("gb", "jp", "xx"):
        for week, day in enumerate(["2019/01/04", "2019/01/11", "2019/01/18", "2019/01/25"]):
            for pos, (tid, (art, gen, exp, name, s)) in enumerate(tracks.items(), 1):
                rows.append(f'{day},{country},{pos},{s + week},{tid},"{art}","{gen}",200,{exp},{name}')
    _write(f"{d}/chart/weekly.csv", rows)
    jobs.chart_job(spark, f"{d}/chart", f"{d}/top", members=["gb", "jp"], k=3)
    top = jobs.read_top_chart(spark, f"{d}/top").collect()
    assert {r["country"] for r in top} == {"gb", "jp"}
    gb = sorted((r["rank"], r["track_id"]) for r in top if r["country"] == "gb")
    assert gb == [(1, "t1"), (2, "t2"), (3, "t3")]  # t5 removed as a duplicate of t1

    jobs.genre_tag_job(spark, f"{d}/top", f"{d}/genres", {"pop": "pop", "rock": "rock"}, n=2)
    g = {(r["country"], r["genre"]): r["count"] for r in io.read_partitioned(spark, f"{d}/genres").collect()}
    assert g[("gb", "pop")] == 1 and g[("gb", "rock")] == 1 and g[("gb", "non-explicit")] == 1

    _write(f"{d}/curated.csv", ["country,year,name,artists,rank,genre", "gb,2019,One,A,1,K-Pop",
                                 "gb,2019,Two,B,2,Pop", "jp,2019,One,A,1,J-Pop"])
    jobs.genre_remap_job(spark, f"{d}/curated.csv", f"{d}/remapped", {"K-Pop": "Pop", "J-Pop": "Pop"})
    r = {(x["country"], x["genre"]): x["count"] for x in io.read_partitioned(spark, f"{d}/remapped").collect()}
    assert r == {("gb", "Pop"): 2, ("jp", "Pop"): 1}

    for ind, vals in (("gdp", {"gb": 4.0, "jp": 3.0}), ("infl", {"gb": 2.0, "jp": 1.0})):
        for code, name in (("gb", "United Kingdom"), ("jp", "Japan")):
            _write(f"{d}/{ind}/{code}_{name}.csv", [f"2019*,{vals[code]}", f"2017,{vals[code]}"])
    _write(f"{d}/global.csv", ["2019,9.5"])
    _write(f"{d}/outcome.csv", ["United Kingdom,2019,7.1", "Japan,2019,6.2", "Spain,2019,6.0"])
    jobs.indicator_job(spark, f"{d}/facts", indicator_dirs={"gdp": f"{d}/gdp", "infl": f"{d}/infl"},
                       global_series={"global_infl": f"{d}/global.csv"},
                       outcome_csv=f"{d}/outcome.csv", developed=["United Kingdom"])
    f = {x["country_code"]: x for x in io.read_partitioned(spark, f"{d}/facts").collect()}
    assert set(f) == {"gb", "jp"} and f["gb"]["developed_country"] and f["jp"]["global_infl"] == 9.5

    _write(f"{d}/corpus.csv", ["title,tag,artist,year,views,features,lyrics,id,language",
                               'One,pop,A,2019,1,{},"love love good",1,en',
                               'One,misc,A,2019,1,{},"skip me",2,en',
                               'Two,rock,B,2019,1,{},"bad sad day",3,en'])
    jobs.text_match_job(spark, f"{d}/top", f"{d}/corpus.csv", f"{d}/matched", f"{d}/queue")
    matched = {x["track_id"]: x["lyrics"] for x in io.read_json(spark, f"{d}/matched").collect()}
    assert matched == {"t1": "love love good", "t2": "bad sad day"}
    queue = io.read_partitioned(spark, f"{d}/queue", fmt="csv", header="true").collect()
    assert sorted(x["track_id"] for x in queue) == ["t3"]

    texts = [{"track_id": "t1", "lyrics": "love love good", "language": "en"},
             {"track_id": "t2", "lyrics": "bad sad day", "language": "en"},
             {"track_id": "t3", "lyrics": None, "language": "en"},
             {"track_id": "t4", "lyrics": "x", "language": "und"}]
    _write(f"{d}/texts/part.json", [json.dumps(t) for t in texts])
    jobs.language_job(spark, f"{d}/texts", f"{d}/lists", f"{d}/bylang", n=2)
    kept = io.read_partitioned(spark, f"{d}/bylang").collect()
    assert sorted(x["track_id"] for x in kept) == ["t1", "t2"]

    jobs.mood_job(spark, f"{d}/bylang", f"{d}/moods", {"en": "stars"})
    moods = {x["track_id"]: x["mood"] for x in io.read_partitioned(spark, f"{d}/moods").collect()}
    assert moods == {"t1": "positive", "t2": "negative"}
    jobs.mood_job(spark, f"{d}/bylang", f"{d}/moods_all")  # per-language route table
    moods_all = {x["track_id"]: x["mood"] for x in io.read_partitioned(spark, f"{d}/moods_all").collect()}
    assert moods_all == moods

    jobs.mood_outcome_job(spark, f"{d}/moods", f"{d}/top", f"{d}/facts", f"{d}/mood_outcome", n=2)
    out = io.read_csv(spark, f"{d}/mood_outcome").collect()
    assert len(out) == 2 and {x["country"] for x in out} == {"United Kingdom", "Japan"}

    jobs.genre_indicator_job(spark, f"{d}/genres", f"{d}/facts", f"{d}/genre_analysis",
                             label_values=["pop", "rock", "other", "explicit", "non-explicit"])
    corr = io.read_csv(spark, f"{d}/genre_analysis/correlation").collect()
    assert len(corr) > 0

    jobs.language_distribution_job(spark, f"{d}/bylang", f"{d}/top", f"{d}/lang",
                                   names={"en": "English"}, years=[2019])
    dist = io.read_csv(spark, f"{d}/lang/distribution").collect()
    assert sorted((x["country"], x["track_count"]) for x in dist) == [("gb", "2"), ("jp", "2")]


def test_cli_arguments_decode_json():
    assert jobs._arg('{"K-Pop": "Pop"}') == {"K-Pop": "Pop"}
    assert jobs._arg('["pop", "rock"]') == ["pop", "rock"]
    assert jobs._arg("/data/in.csv") == "/data/in.csv"
    assert jobs._arg("3") == 3 and jobs._arg("0.75") == 0.75
    assert set(jobs.JOBS) >= {"chart", "genre-remap", "genre-tags", "text-match", "languages",
                              "moods", "mood-outcome", "genre-indicators", "language-distribution"}
