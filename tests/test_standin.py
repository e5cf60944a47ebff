"""The stand-in gives the hours, trips and zones of all given rows."""

from datetime import datetime, timedelta

from fareweather.plans.standin import weather_from_events


def test_every_hour_with_an_event_has_weather(spark):
    hours = [datetime(2024, 1, 1) + timedelta(hours=h) for h in range(0, 31 * 24)]
    events = spark.createDataFrame([(at + timedelta(minutes=7),) for at in hours], "ts timestamp_ntz")
    got = weather_from_events(events).select("weather_datetime", "pickup_date", "pickup_hour").collect()
    assert sorted(r["weather_datetime"] for r in got) == hours
    assert {(r["pickup_date"], r["pickup_hour"]) for r in got} == {(str(at.date()), at.hour) for at in hours}


def test_hours_without_weather_stay_a_choice_of_tests(spark):
    events = spark.createDataFrame([(datetime(2024, 1, 1, h),) for h in range(24)], "ts timestamp_ntz")
    assert weather_from_events(events, gaps=True).count() == 23
