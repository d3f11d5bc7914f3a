"""Versions published by one pointer, stopped after every step."""

import pytest

from labmart.sinks import PublishError, current_version, publish_version, published
from labmart.sinks.versions import publish_steps


def sizes(spark, database):
    return tuple(published(spark, database, t).count() for t in ("a", "b"))


def test_a_stop_anywhere_shows_all_old_or_all_new(spark, database):
    new = {"a": spark.range(5), "b": spark.range(7)}
    with pytest.raises(LookupError):
        published(spark, database, "a")
    publish_version(spark, database, {"a": spark.range(2), "b": spark.range(3)})
    seen = []
    for stop in range(1, 20):
        publish_version(spark, database, {"a": spark.range(2), "b": spark.range(3)})
        steps = publish_steps(spark, database, new, keep=1)
        done = [step for _, step in zip(range(stop), steps)]
        steps.close()
        seen.append((done[-1][0], sizes(spark, database)))
        if len(done) < stop:
            break
    assert {s for s, _ in seen} == {"write", "check", "switch", "drop"}
    assert all(found == ((5, 7) if stage in ("switch", "drop") else (2, 3)) for stage, found in seen)


def test_complaints_and_old_versions(spark, database):
    publish_version(spark, database, {"a": spark.range(2), "b": spark.range(3)})
    first = current_version(spark, database)
    with pytest.raises(PublishError, match="b: empty"):
        publish_version(spark, database, {"a": spark.range(5), "b": spark.range(0)}, checks={"b": lambda df: ["empty"]})
    assert current_version(spark, database) == first and sizes(spark, database) == (2, 3)
    for n in (6, 8):
        publish_version(spark, database, {"a": spark.range(n), "b": spark.range(n)}, keep=1)
    assert sizes(spark, database) == (8, 8)
    left = [t.name for t in spark.catalog.listTables(database)]
    assert len(left) == 3 and not any(first in t for t in left)
