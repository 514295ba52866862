"""Alerts of a channel are chosen without a task that holds all its incidents."""

from caseloom.operators import analytics


def test_incidents_are_not_dealt_by_channel(spark):
    incidents = spark.range(1000).selectExpr(
        "if(id % 2 = 0, 'chat', 'mail') as channel", "format_string('u%04d', id) as uid",
        "if(id % 10 = 1, 'law_enforcement_action', 'hack_exploit') as incident_type", "if(id % 3 = 0, null, cast(id as double)) as amount_usd")
    channels = spark.createDataFrame([("chat", 0.0, 3), ("mail", 990.0, 100), ("none", 0.0, 5)], "channel string, min_amount double, max_per_run int")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables of unknown size
    try:
        worth = analytics.worth_alerting(incidents, channels)
        assert "hashpartitioning(channel" not in worth._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert worth.where("channel = 'chat'").count() == 500
    got = [(r.channel, r.uid, r.position) for r in analytics.top_alerts(incidents, channels).orderBy("channel", "position").collect()]
    amounts = {i: (0.0 if i % 3 == 0 else float(i)) for i in range(1000)}
    want = []
    for name, odd, least, most in (("chat", 0, 0.0, 3), ("mail", 1, 990.0, 100)):
        held = sorted((i for i in range(1000) if i % 2 == odd and (least == 0 or amounts[i] >= least or i % 10 == 1)), key=lambda i: (-amounts[i], i))
        want += [(name, f"u{i:04d}", n) for n, i in enumerate(held[:most], 1)]
    assert got == want and len(got) > 50
