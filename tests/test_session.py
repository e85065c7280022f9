import pytest

from wxpipe.session import require_utc

ZONE = "spark.sql.session.timeZone"


@pytest.mark.parametrize("zone", ["UTC", "Etc/UTC", "Z", "+00:00", "GMT"])
def test_zones_without_offset_are_taken(spark, zone):
    before = spark.conf.get(ZONE)
    spark.conf.set(ZONE, zone)
    try:
        require_utc(spark)
    finally:
        spark.conf.set(ZONE, before)


@pytest.mark.parametrize("zone", ["America/New_York", "Europe/London", "+01:00"])
def test_zones_that_move_times_are_refused(spark, zone):
    before = spark.conf.get(ZONE)
    spark.conf.set(ZONE, zone)
    try:
        with pytest.raises(ValueError, match="need UTC"):
            require_utc(spark)
    finally:
        spark.conf.set(ZONE, before)
