"""State machines must run on executors that lack this package."""

import subprocess
import sys
import types

from pyspark import cloudpickle

from fleetlens.streaming import logwaits, timelines, waits

LOAD = "import pickle, sys; make = pickle.load(sys.stdin.buffer); print(make(None).dump())"


def elsewhere(make):
    data = cloudpickle.dumps(make)
    done = subprocess.run([sys.executable, "-c", LOAD], input=data, cwd="/", capture_output=True, env={})
    return done.stdout.decode().strip() or done.stderr.decode()


def test_machines_load_without_the_package():
    show = types.SimpleNamespace
    assert elsewhere(lambda s: show(dump=lambda: timelines._Timelines(True, 5).forget_us)) == "5"
    assert elsewhere(lambda s: show(dump=lambda: logwaits._LogWaits(20).limit)) == "20"
    assert elsewhere(lambda s: show(dump=lambda: waits._FirstEnd(waits._run_end, ["ts"], [], False, 7).forget_ms)) == "7"
