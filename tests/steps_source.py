"""A streaming source whose offsets look like those of a topic with one partition."""

import json
import sys

from pyspark import cloudpickle
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader


cloudpickle.register_pickle_by_value(sys.modules[__name__])


class StepsSource(DataSource):
    """Numbers up to ``until``; begins at ``startingOffsets``, which are exclusive ends."""

    @classmethod
    def name(cls):
        return "steps"

    def schema(self):
        return "number bigint"

    def simpleStreamReader(self, schema):
        return StepsReader(self.options)


class StepsReader(SimpleDataSourceStreamReader):
    def __init__(self, options):
        self.until = int(options["until"])
        self.begin = options.get("startingOffsets", json.dumps({"steps": {"0": 0}}))

    def initialOffset(self):
        return json.loads(self.begin)

    def read(self, start):
        first = start["steps"]["0"]
        end = max(first, self.until)
        return iter([(n,) for n in range(first, end)]), {"steps": {"0": end}}

    def readBetweenOffsets(self, start, end):
        return iter([(n,) for n in range(start["steps"]["0"], end["steps"]["0"])])

    def commit(self, end):
        pass
