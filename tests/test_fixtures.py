"""The derived feeds keep keys apart at any size."""

from clickloom import fixtures


def test_long_keys_are_padded_but_never_cut(spark):
    part = spark.createDataFrame([(7, "a", "t"), (999, "b", "t"), (1234567, "c", "t"), (1234568, "d", "t")],
                                 "p_partkey bigint, p_name string, p_type string")
    ids = {r.campaign_id for r in fixtures.raw_campaigns(part).collect()}
    assert ids == {"C008", "C1000", "C1234568", "C1234569"}


def test_every_part_is_a_campaign(spark, feeds):
    assert feeds.campaigns.count() == feeds._table("part").count()
    shown = feeds.impressions.select("campaign_id").distinct().join(feeds.campaigns, "campaign_id", "left_anti")
    assert shown.count() == 0
