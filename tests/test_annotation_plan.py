"""The annotation plan: nothing is written on the way and placed rows are dealt out once."""

from auditflow.fixtures import Tables
from auditflow.operators import report
from auditflow.plans import pipelines


def test_judged_rows_are_not_written_down(spark, data, monkeypatch):
    def no_writing(_):
        raise AssertionError("written down")

    monkeypatch.setattr(pipelines, "checkpointed", no_writing)
    t = Tables(spark, data)
    plan = pipelines.annotation_import_plan(t.fx_annotation, t.fx_page, t.fx_media, size=32)
    assert plan.summary.first().annotation_count == plan.pages.agg({"n_items": "sum"}).first()[0] > 1000


def test_placed_rows_are_dealt_out_once(spark):
    placed = spark.sql("SELECT 'f' AS path, id % 3 AS page, CASE WHEN id % 2 = 0 THEN 0.1D ELSE 1e22D END AS page_width, -0.0D AS page_height, 0.3D AS scale, string(id) AS id, id AS pos, "
                       "'audio' AS type, 1.0D AS left_px, 1.0D AS top_px, 1.0D AS width_px, 1.0D AS height_px FROM range(60)")
    out = report.plan_by_page(placed, 4)
    assert out._jdf.queryExecution().executedPlan().toString().count("hashpartitioning") == 1
    rows = out.collect()
    assert {(r.page, r.page_width, r.page_height, r.scale, r.canvas_height) for r in rows} == {(p, w, 0.0, 0.3, 0.0) for p in range(3) for w in (0.1, 1e22)}
    assert sorted(int(a.id) for r in rows for a in r.annotations) == list(range(60)) and max(r.n_items for r in rows) == 4
