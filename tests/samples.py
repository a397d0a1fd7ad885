"""Small hand-made inputs."""

import json

TIMES = ["2025-09-24T09:00", "2025-09-24T10:00", "2025-09-25T09:00"]


def payload(city="Paris", **changes):
    """A payload of the first dialect."""
    data = {
        "city": city,
        "latitude": 48.85,
        "longitude": 2.35,
        "generationtime_ms": 0.7,
        "timezone": "UTC",
        "current_weather": {
            "temperature": 17.6, "windspeed": 11.9, "winddirection": 145, "weathercode": 2, "time": "2025-09-24T09:00",
        },
        "hourly": {
            "time": TIMES,
            "temperature_2m": [10.0, 12.0, 17.0],
            "relative_humidity_2m": [50, 60, 70],
            "precipitation": [0.0, 0.5, 1.5],
            "windspeed_10m": [5.0, 10.0, 15.0],
            "winddirection_10m": [0.0, 90.0, 350.0],
        },
    }
    data.update(changes)
    return {key: value for key, value in data.items() if value is not ...}


def second_dialect(city="Lyon", **current):
    values = {"temperature_2m": 36.0, "relative_humidity_2m": 40.0, "precipitation": 0.0, "wind_speed_10m": 20.0}
    return {
        "city": city,
        "timestamp": "2025-09-24T09:30:00+02:00",
        "current": {**values, **current},
        "hourly": {
            "time": TIMES,
            "temperature_2m": [36.0, 20.0, -1.0],
            "relative_humidity_2m": [40.0, 50.5, 60.0],
            "precipitation": [0.0, 26.0, 0.0],
            "wind_speed_10m": [20.0, 51.0, 50.0],
        },
    }


def drop(folder, name, content):
    folder.mkdir(parents=True, exist_ok=True)
    text = content if isinstance(content, str) else json.dumps(content)
    (folder / name).write_text(text, encoding="utf-8")
