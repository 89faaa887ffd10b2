"""The declarative E2 graph: registration and batch evaluation of its views."""

import os

from pyspark import pipelines as dp  # noqa: F401  (API must import)
from pyspark.pipelines.graph_element_registry import GraphElementRegistry, graph_element_registration_context
from pyspark.pipelines.output import MaterializedView, StreamingTable

from conftest import SF_SMALL, rows
from lakeforge.plans import catalog, quakes
from lakeforge.session import read_table
from lakeforge.streaming.declarative import define_quake_pipeline


class RecordingRegistry(GraphElementRegistry):
    def __init__(self):
        self.outputs, self.flows = [], []

    def register_output(self, output):
        self.outputs.append(output)

    def register_flow(self, flow):
        self.flows.append(flow)

    def register_sql(self, sql_text, file_path):
        raise AssertionError("no SQL in this graph")


def test_quake_graph_registers_and_views_match_batch(spark, tmp_dir):
    reg = RecordingRegistry()
    with graph_element_registration_context(reg):
        names = define_quake_pipeline(spark, os.path.join(tmp_dir, "raw"), prefix="t_quake")
    kinds = {o.name: type(o) for o in reg.outputs}
    assert kinds[names["bronze"]] is StreamingTable and kinds[names["silver_stream"]] is StreamingTable
    for role in ("silver_current", "hotspot", "activity"):
        assert kinds[names[role]] is MaterializedView
    flows = {f.target: f.func for f in reg.flows}
    assert set(flows) == set(names.values())

    # Evaluate the materialized views in batch over the batch twin of the
    # streaming tables (the runner would maintain them incrementally).
    catalog._prep(spark)
    silver = quakes.silver_transform(quakes.feed_from_events(read_table(spark, SF_SMALL, "events")))
    from lakeforge.functions import hash_id

    silver.select(*quakes.SILVER_COLUMNS).dropDuplicates().withColumn("hash_id", hash_id("id", "time")) \
        .createOrReplaceTempView(names["silver_stream"])
    flows[names["silver_current"]]().createOrReplaceTempView(names["silver_current"])
    got = flows[names["activity"]]()
    expect = catalog.REGISTRY["quake_seismic_activity"](spark, SF_SMALL)
    assert rows(catalog.rounded(got, {"avg_mag": 6})) == rows(expect)
