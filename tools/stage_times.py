"""Summarise a Spark event log: per job and stage wall time and task count.

usage: python tools/stage_times.py <event-log-file>
"""

import json
import sys
from collections import defaultdict


def lines_of(path: str):
    import glob
    import io
    import os
    if os.path.isdir(path):
        path = sorted(glob.glob(os.path.join(path, "**", "events_*"), recursive=True))[0]
    if path.endswith(".zstd"):
        import zstandard
        with open(path, "rb") as f:
            data = zstandard.ZstdDecompressor().stream_reader(f).read()
        return io.StringIO(data.decode("utf-8"))
    return open(path)


def main(path: str) -> None:
    stages, jobs = {}, {}
    job_of_stage = {}
    for line in lines_of(path):
        e = json.loads(line)
        ev = e.get("Event")
        if ev == "SparkListenerJobStart":
            jobs[e["Job ID"]] = [e["Submission Time"], None, e.get("Properties", {}).get("spark.job.description", "")]
            for s in e["Stage IDs"]:
                job_of_stage[s] = e["Job ID"]
        elif ev == "SparkListenerJobEnd":
            jobs[e["Job ID"]][1] = e["Completion Time"]
        elif ev == "SparkListenerStageCompleted":
            i = e["Stage Info"]
            stages[i["Stage ID"]] = (i.get("Submission Time"), i.get("Completion Time"), i["Number of Tasks"], i["Stage Name"][:60])
    per_job = defaultdict(list)
    for sid, st in stages.items():
        per_job[job_of_stage.get(sid)].append((sid, st))
    for jid, (a, b, d) in sorted(jobs.items()):
        dur = (b - a) if b else None
        print(f"job {jid}: {dur} ms {d[:60]}")
        for sid, (sa, sb, n, name) in sorted(per_job[jid]):
            print(f"    stage {sid}: {(sb - sa) if sa and sb else None} ms, {n} tasks, {name}")


if __name__ == "__main__":
    main(sys.argv[1])
