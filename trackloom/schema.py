"""The normalized dataset: table schemas and the label taxonomy."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Table layouts. Links use the empty string at chain ends, cameras alone have an intrinsic matrix.
TABLES = {
    "sensor": "token string, channel string, modality string",
    "calibrated_sensor": "token string, sensor_token string, translation array<double>, rotation array<double>, camera_intrinsic array<array<double>>",
    "log": "token string, logfile string, vehicle string, date_captured string, location string, global_frame string",
    "scene": "token string, name string, description string, log_token string, nbr_samples int, first_sample_token string, last_sample_token string",
    "sample": "token string, timestamp bigint, scene_token string, prev string, next string",
    "sample_data": "token string, sample_token string, ego_pose_token string, calibrated_sensor_token string, filename string, fileformat string, is_key_frame boolean, height int, width int, timestamp bigint, prev string, next string",
    "ego_pose": "token string, translation array<double>, rotation array<double>, timestamp bigint",
    "sample_annotation": "token string, sample_token string, instance_token string, attribute_tokens array<string>, visibility_token string, translation array<double>, size array<double>, rotation array<double>, prev string, next string, num_lidar_pts int, num_radar_pts int",
    "instance": "token string, category_token string, nbr_annotations int, first_annotation_token string, last_annotation_token string",
    "category": "token string, name string, description string, index int",
    "attribute": "token string, name string, description string",
    "visibility": "token string, level string, description string",
    "map": "token string, category string, filename string, log_tokens array<string>",
}

# Object type -> (category, description)
CATEGORIES = {
    0: ("unknown", "Unclassified object."),
    1: ("vehicle.car", "Passenger car, SUV, van."),
    2: ("vehicle.bus", "Bus or coach."),
    3: ("vehicle.truck", "Truck or lorry."),
    4: ("vehicle.construction", "Construction vehicle."),
    5: ("vehicle.bicycle", "Bicycle, with or without rider."),
    6: ("vehicle.tricycle", "Three-wheeled vehicle."),
    7: ("human.pedestrian", "Pedestrian."),
    8: ("movable_object.trafficcone", "Traffic cone."),
    9: ("movable_object.barrow", "Hand cart or barrow."),
    10: ("animal", "Animal other than a bird."),
    11: ("movable_object.warning_triangle", "Roadside warning triangle."),
    12: ("animal.bird", "Bird."),
    13: ("movable_object.water_barrier", "Water-filled barrier."),
    14: ("static_object.lamp_post", "Lamp or utility post."),
    15: ("static_object.traffic_sign", "Traffic sign."),
    16: ("static_object.warning_post", "Warning post or delineator."),
    17: ("movable_object.traffic_barrel", "Traffic barrel."),
    18: ("vehicle.articulated_head", "Tractor unit of an articulated vehicle."),
    19: ("vehicle.articulated_body", "Trailer of an articulated vehicle."),
    20: ("vision_obstacle", "Obstacle detected by vision only."),
    50: ("static_object.unknown", "Unclassified static object."),
}

# Motion state -> (attribute, description)
ATTRIBUTES = {
    0: ("motion.unknown", "Motion state could not be determined."),
    1: ("motion.stationary", "Never observed to move."),
    2: ("motion.stopped", "Temporarily stopped but able to move."),
    3: ("motion.moving_slowly", "Moving at or below 5 km/h."),
    4: ("motion.moving", "Moving above 5 km/h."),
}

# Visibility bins; their tokens are "1" to "4"
VISIBILITY = [
    ("v0-40", "Between 0 and 40% visible."),
    ("v40-60", "Between 40 and 60% visible."),
    ("v60-80", "Between 60 and 80% visible."),
    ("v80-100", "Between 80 and 100% visible."),
]


def taxonomy(spark: SparkSession) -> dict[str, DataFrame]:
    """The three label tables; a few dozen fixed rows."""
    cats = [(f"category/{n}", n, d, i) for i, (_, (n, d)) in enumerate(sorted(CATEGORIES.items()))]
    attrs = [(f"attribute/{n}", n, d) for _, (n, d) in sorted(ATTRIBUTES.items())]
    vis = [(str(i), level, d) for i, (level, d) in enumerate(VISIBILITY, 1)]
    return {
        "category": spark.createDataFrame(cats, TABLES["category"]),
        "attribute": spark.createDataFrame(attrs, TABLES["attribute"]),
        "visibility": spark.createDataFrame(vis, TABLES["visibility"]),
    }
