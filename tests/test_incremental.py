"""Runs that read each file once equal one full run."""

import os

import pytest
from pyspark.sql import functions as F

from postlake.operators.clean import CLEANERS
from postlake.plans import incremental as inc
from postlake.plans import questions as q
from postlake.plans.lake import lake
from postlake.schemas import RAW
from postlake.sinks.files import write_topic


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def part(spark, sf_small, i, of=3):
    lk = lake(spark, sf_small)
    return {k: lk.raw(k).where(F.col(RAW[k][0].name) % of == i) for k in RAW}


def add(topics, tables):
    for kind, raw in tables.items():
        write_topic(raw, topics, kind)


def check(spark, state, *parts):
    """The four answers against the questions over all rows so far."""
    clean = {}
    for kind in RAW:
        raw = parts[0][kind]
        for more in parts[1:]:
            raw = raw.unionByName(more[kind])
        clean[kind] = CLEANERS[kind](raw)
    g, p, u = clean["geo"], clean["posts"], clean["users"]
    assert rows(inc.category_counts_by_country(spark, state)) == rows(q.category_counts_by_country(g, p))
    assert rows(inc.posts_per_category_year(spark, state)) == rows(q.posts_per_category_year(g, p))
    assert rows(inc.category_counts_by_age_group(spark, state)) == rows(q.category_counts_by_age_group(u, p))
    assert rows(inc.users_joined_by_year(spark, state)) == rows(q.users_joined_by_year(u))


def test_runs_equal_a_full_run_and_open_new_files_only(spark, sf_small, tmp_path):
    topics, state = str(tmp_path / "topics"), str(tmp_path / "state")
    parts = [part(spark, sf_small, i) for i in range(3)]
    add(topics, parts[0])
    assert all(n > 0 for n in inc.update(spark, topics, state).values())
    check(spark, state, parts[0])
    for path, _, files in os.walk(topics):  # the old files cannot be opened any more
        for f in files:
            os.remove(os.path.join(path, f))
    assert inc.update(spark, topics, state) == dict.fromkeys(RAW, 0)
    add(topics, parts[1])
    inc.update(spark, topics, state)
    check(spark, state, *parts[:2])
    assert inc.compact(spark, state) == 2 and inc.compact(spark, state) == 0
    check(spark, state, *parts[:2])
    write_topic(parts[2]["geo"], topics, "geo")  # one topic is ahead of the others
    assert inc.update(spark, topics, state)["posts"] == 0
    write_topic(parts[2]["posts"], topics, "posts")
    write_topic(parts[2]["users"], topics, "users")
    inc.update(spark, topics, state)
    check(spark, state, *parts)


def test_a_run_that_failed_is_repeated(spark, sf_small, tmp_path, monkeypatch):
    topics, state = str(tmp_path / "topics"), str(tmp_path / "state")
    parts = [part(spark, sf_small, i) for i in range(2)]
    add(topics, parts[0])
    inc.update(spark, topics, state)
    add(topics, parts[1])
    commit = inc.State.commit
    monkeypatch.setattr(inc.State, "commit", lambda self, m: (_ for _ in ()).throw(OSError("stopped")))
    with pytest.raises(OSError):
        inc.update(spark, topics, state)
    check(spark, state, parts[0])  # its counts are there, but not in the manifest
    monkeypatch.setattr(inc.State, "commit", commit)
    inc.update(spark, topics, state)
    check(spark, state, *parts)


def test_a_changed_file_is_refused_and_no_files_are_fine(spark, sf_small, tmp_path):
    topics, state = str(tmp_path / "topics"), str(tmp_path / "state")
    assert inc.update(spark, topics, state) == dict.fromkeys(RAW, 0)
    assert rows(inc.category_counts_by_country(spark, state)) == []
    add(topics, part(spark, sf_small, 0))
    inc.update(spark, topics, state)
    folder = f"{topics}/posts/partition=0"
    name = next(f for f in os.listdir(folder) if f.endswith(".json"))
    with open(f"{folder}/{name}", "a") as f:
        f.write('{"index":1}\n')
    os.path.exists(f"{folder}/.{name}.crc") and os.remove(f"{folder}/.{name}.crc")
    with pytest.raises(ValueError, match="changed"):
        inc.update(spark, topics, state)
