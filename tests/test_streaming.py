from pyspark.sql import functions as F

from basketry.operators import cleaning
from basketry.sources.schemas import RAW
from basketry.streaming.daily_totals import daily_totals, run_available


def test_stream_equals_batch_for_finished_days(spark, lines, tmp_path):
    def day(i, **more):
        return {"invoice": f"{i}", "invoice_date": f"2011-01-{i:02d} 10:00:00", "quantity": i, **more}

    landing, out, state = (str(tmp_path / n) for n in ("landing", "out", "state"))
    first = lines(day(1), day(1), day(2), day(2, invoice="C2"), day(3))
    second = lines(day(4), day(4, stock_code="POST"), day(9))
    for extract in (first, second):
        extract.coalesce(1).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(RAW).parquet(landing)
        query = run_available(daily_totals(stream), out, state)
        query.awaitTermination(120)
        assert query.exception() is None
    got = {str(r["date"]): (r["quantity"], r["n_lines"]) for r in spark.read.parquet(out).collect()}
    everything = cleaning.clean_transactions(first.unionByName(second))["completed_sales"]
    batch = everything.groupBy(F.to_date("invoice_date").alias("d")).agg(F.sum("quantity"), F.count("*")).collect()
    assert got == {str(r[0]): (r[1], r[2]) for r in batch if str(r[0]) < "2011-01-07"}
