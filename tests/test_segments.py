"""Landing files of messages as segments with offsets."""
import os

from quotelake.sources import segments
from quotelake.streaming import jobs


def put(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write("".join(x + "\n" for x in lines))


def landed(spark, base):
    rows = spark.read.parquet(base + "/segments")
    return sorted((r.partition, r.offset, r.value, r.segment, r.topic.rsplit("/", 1)[1]) for r in rows.collect())


def drain(spark, base, tmp_dir, sizes):
    def keep(df, batch_id):
        sizes.append(df.count())
        df.write.mode("append").parquet(tmp_dir + "/out")
    jobs.run_available_now(segments.segment_stream(jobs.stream_session(spark), base), tmp_dir + "/ckpt", foreach_batch=keep)


def test_offsets_and_caps(spark, tmp_dir):
    incoming, base = tmp_dir + "/in", tmp_dir + "/seg"
    put(incoming, "a.json", [f"a{i}" for i in range(23)])
    put(incoming, "b.json", ["b0"])
    assert segments.land(spark, incoming, base, 10) == 24 and segments.land(spark, incoming, base, 10) == 0
    sizes = []
    drain(spark, base, tmp_dir, sizes)
    assert sorted(sizes) == [4, 10, 10]
    put(incoming, "c.json", [f"c{i}" for i in range(12)] + [""])
    assert segments.land(spark, incoming, base, 10) == 13
    drain(spark, base, tmp_dir, sizes)                       # a restart reads the new segments only
    assert sorted(sizes) == [3, 4, 10, 10, 10]
    rows = landed(spark, base)
    assert [r[1] for r in rows] == list(range(37))
    for name, n in (("a", 23), ("b", 1), ("c", 12)):         # lines keep their order within a file
        mine = [r[2] for r in rows if r[4] == name + ".json" and r[2]]
        assert mine == [f"{name}{i}" for i in range(n)]
    out = spark.read.parquet(tmp_dir + "/out")
    assert sorted(r.offset for r in out.collect()) == list(range(37))


def test_a_failed_landing_is_repeated_with_its_plan(spark, tmp_dir):
    incoming, base = tmp_dir + "/in", tmp_dir + "/seg"
    put(incoming, "a.json", ["a0", "a1"])
    assert segments._plan(spark, incoming, base, 0, 1)       # planned, then lost before its segments were in place
    put(incoming, "b.json", ["b0"])
    assert segments.land(spark, incoming, base, 10) == 2     # the planned file only
    assert segments.land(spark, incoming, base, 10) == 1
    assert [(r[1], r[2]) for r in landed(spark, base)] == [(0, "a0"), (1, "a1"), (2, "b0")]


def test_partitions_have_offsets_of_their_own(spark, tmp_dir):
    incoming, base = tmp_dir + "/in", tmp_dir + "/seg"
    for k in range(6):
        put(incoming, f"f{k}.json", [f"{k}-{i}" for i in range(k + 1)])
    assert segments.land(spark, incoming, base, 4, partitions=3) == 21
    rows = landed(spark, base)
    for p in {r[0] for r in rows}:
        assert [r[1] for r in rows if r[0] == p] == list(range(sum(r[0] == p for r in rows)))
    per = {}
    for r in rows:
        per.setdefault(r[3], set()).add(r[0])
    assert all(len(v) == 1 for v in per.values()) and all(sum(r[3] == s for r in rows) <= 4 for s in per)


def test_lanes_share_the_segments_and_resume_on_their_own(spark, tmp_dir):
    incoming, base, seen = tmp_dir + "/in", tmp_dir + "/seg", []

    def drain_lanes():
        for lane in range(3):
            def keep(df, batch_id):
                seen.append((lane, batch_id, sorted(r.offset for r in df.collect())))
            stream = segments.segment_stream(jobs.stream_session(spark), base, lane=lane)
            jobs.run_available_now(stream, f"{tmp_dir}/ckpt/{lane}", foreach_batch=keep)

    put(incoming, "a.json", [f"a{i}" for i in range(23)])
    assert segments.land(spark, incoming, base, 10, lanes=3) == 23
    drain_lanes()
    put(incoming, "b.json", [f"b{i}" for i in range(12)])
    assert segments.land(spark, incoming, base, 10, lanes=3) == 12
    drain_lanes()                                            # the third lane has nothing new
    assert sorted(seen) == [(0, 0, list(range(10))), (0, 1, list(range(23, 33))), (1, 0, list(range(10, 20))),
                            (1, 1, [33, 34]), (2, 0, [20, 21, 22])]
