"""Rule tables: site groups, temperature breakpoints, night hours and lag lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# ---- fixed values ---------------------------------------------------------
#: (site, cluster)
SITE_CLUSTERS = [
    ("A", 2),
    ("B", 1),
    ("C", 1),
    ("D", 2),
    ("E", 0),
    ("F", 0),
    ("G", 1),
    ("H", 2),
    ("I", 0),
    ("J", 0),
    ("K", 0),
    ("L", 3),
    ("M", 3),
    ("N", 0),
    ("O", 0),
    ("P", 2),
    ("Q", 0),
    ("R", 3),
    ("S", 3),
]

#: site: lower and upper temperature breakpoint
TA_BREAKPOINTS = {
    "A": (-4.6, 16.51),
    "B": (-7.52, 16.92),
    "C": (-4.19, 18.07),
    "D": (-4.13, 14.22),
    "E": (10.86, 23.04),
    "F": (-7.58, 13.99),
    "G": (-7.5, 17.02),
    "H": (-5.72, 16.38),
    "I": (-6.26, 15.77),
    "J": (13.76, 21.94),
    "K": (-4.7, 17.85),
    "L": (-0.7, 17.96),
    "M": (-0.3, 18.05),
    "N": (-2.58, 17.37),
    "O": (-5.0, 17.04),
    "P": (-7.3, 17.81),
    "Q": (-9.1, 17.09),
    "R": (-6.1, 18.8),
    "S": (-8.83, 17.29),
}

#: sites counted as sensitive to discomfort
DISCOMFORT_SITES = ["C", "D", "E", "J", "K", "P", "R", "S"]

#: (site, first month-day, last month-day, night start hour, night end hour)
NIGHT_RULES = [
    ("A", 101, 206, 19, 7),
    ("A", 206, 304, 20, 7),
    ("A", 304, 407, 20, 6),
    ("A", 407, 413, 21, 6),
    ("A", 413, 828, 21, 5),
    ("A", 828, 903, 21, 6),
    ("A", 903, 1012, 20, 6),
    ("A", 1012, 1103, 19, 6),
    ("A", 1103, 1231, 19, 7),
    ("B", 101, 206, 19, 7),
    ("B", 206, 304, 20, 7),
    ("B", 304, 407, 20, 6),
    ("B", 407, 413, 21, 6),
    ("B", 413, 828, 21, 5),
    ("B", 828, 903, 21, 6),
    ("B", 903, 1012, 20, 6),
    ("B", 1012, 1103, 19, 6),
    ("B", 1103, 1231, 19, 7),
    ("C", 101, 206, 19, 7),
    ("C", 206, 304, 20, 7),
    ("C", 304, 407, 20, 6),
    ("C", 407, 413, 21, 6),
    ("C", 413, 828, 21, 5),
    ("C", 828, 903, 21, 6),
    ("C", 903, 1012, 20, 6),
    ("C", 1012, 1103, 19, 6),
    ("C", 1103, 1231, 19, 7),
    ("D", 101, 205, 19, 7),
    ("D", 205, 304, 20, 7),
    ("D", 304, 407, 20, 6),
    ("D", 407, 414, 21, 6),
    ("D", 414, 828, 21, 5),
    ("D", 828, 903, 21, 6),
    ("D", 903, 1013, 20, 6),
    ("D", 1013, 1104, 19, 6),
    ("D", 1104, 1231, 19, 7),
    ("E", 101, 205, 19, 7),
    ("E", 205, 304, 20, 7),
    ("E", 304, 407, 20, 6),
    ("E", 407, 414, 21, 6),
    ("E", 414, 828, 21, 5),
    ("E", 828, 903, 21, 6),
    ("E", 903, 1013, 20, 6),
    ("E", 1013, 1104, 19, 6),
    ("E", 1104, 1231, 19, 7),
    ("F", 101, 206, 19, 7),
    ("F", 206, 304, 20, 7),
    ("F", 304, 407, 20, 6),
    ("F", 407, 413, 21, 6),
    ("F", 413, 828, 21, 5),
    ("F", 828, 903, 21, 6),
    ("F", 903, 1012, 20, 6),
    ("F", 1012, 1103, 19, 6),
    ("F", 1103, 1231, 19, 7),
    ("G", 101, 205, 19, 7),
    ("G", 205, 304, 20, 7),
    ("G", 304, 407, 20, 6),
    ("G", 407, 414, 21, 6),
    ("G", 414, 828, 21, 5),
    ("G", 828, 903, 21, 6),
    ("G", 903, 1013, 20, 6),
    ("G", 1013, 1104, 19, 6),
    ("G", 1104, 1231, 19, 7),
    ("H", 101, 205, 19, 7),
    ("H", 205, 304, 20, 7),
    ("H", 304, 407, 20, 6),
    ("H", 407, 414, 21, 6),
    ("H", 414, 828, 21, 5),
    ("H", 828, 903, 21, 6),
    ("H", 903, 1013, 20, 6),
    ("H", 1013, 1104, 19, 6),
    ("H", 1104, 1231, 19, 7),
    ("I", 101, 205, 19, 7),
    ("I", 205, 304, 20, 7),
    ("I", 304, 407, 20, 6),
    ("I", 407, 414, 21, 6),
    ("I", 414, 828, 21, 5),
    ("I", 828, 903, 21, 6),
    ("I", 903, 1013, 20, 6),
    ("I", 1013, 1104, 19, 6),
    ("I", 1104, 1231, 19, 7),
    ("J", 101, 205, 19, 7),
    ("J", 205, 304, 20, 7),
    ("J", 304, 407, 20, 6),
    ("J", 407, 414, 21, 6),
    ("J", 414, 828, 21, 5),
    ("J", 828, 903, 21, 6),
    ("J", 903, 1013, 20, 6),
    ("J", 1013, 1104, 19, 6),
    ("J", 1104, 1231, 19, 7),
    ("K", 101, 205, 19, 7),
    ("K", 205, 304, 20, 7),
    ("K", 304, 407, 20, 6),
    ("K", 407, 414, 21, 6),
    ("K", 414, 828, 21, 5),
    ("K", 828, 903, 21, 6),
    ("K", 903, 1013, 20, 6),
    ("K", 1013, 1104, 19, 6),
    ("K", 1104, 1231, 19, 7),
    ("L", 101, 210, 19, 7),
    ("L", 210, 225, 20, 7),
    ("L", 225, 409, 20, 6),
    ("L", 409, 419, 20, 5),
    ("L", 419, 826, 21, 5),
    ("L", 826, 904, 20, 5),
    ("L", 904, 1007, 20, 6),
    ("L", 1007, 1113, 19, 6),
    ("L", 1113, 1231, 19, 7),
    ("M", 101, 210, 19, 7),
    ("M", 210, 225, 20, 7),
    ("M", 225, 409, 20, 6),
    ("M", 409, 419, 20, 5),
    ("M", 419, 826, 21, 5),
    ("M", 826, 904, 20, 5),
    ("M", 904, 1007, 20, 6),
    ("M", 1007, 1113, 19, 6),
    ("M", 1113, 1231, 19, 7),
    ("N", 101, 210, 19, 7),
    ("N", 210, 225, 20, 7),
    ("N", 225, 409, 20, 6),
    ("N", 409, 419, 20, 5),
    ("N", 419, 826, 21, 5),
    ("N", 826, 904, 20, 5),
    ("N", 904, 1007, 20, 6),
    ("N", 1007, 1113, 19, 6),
    ("N", 1113, 1231, 19, 7),
    ("O", 101, 206, 19, 7),
    ("O", 206, 302, 20, 7),
    ("O", 302, 411, 20, 6),
    ("O", 411, 413, 21, 6),
    ("O", 413, 830, 21, 5),
    ("O", 830, 901, 21, 6),
    ("O", 901, 1011, 20, 6),
    ("O", 1011, 1107, 19, 6),
    ("O", 1107, 1231, 19, 7),
    ("P", 101, 206, 19, 7),
    ("P", 206, 303, 20, 7),
    ("P", 303, 410, 20, 6),
    ("P", 410, 413, 21, 6),
    ("P", 413, 830, 21, 5),
    ("P", 830, 902, 21, 6),
    ("P", 902, 1012, 20, 6),
    ("P", 1012, 1106, 19, 6),
    ("P", 1106, 1231, 19, 7),
    ("Q", 101, 205, 19, 7),
    ("Q", 205, 305, 20, 7),
    ("Q", 305, 407, 20, 6),
    ("Q", 407, 414, 21, 6),
    ("Q", 414, 828, 21, 5),
    ("Q", 828, 903, 21, 6),
    ("Q", 903, 1013, 20, 6),
    ("Q", 1013, 1102, 19, 6),
    ("Q", 1102, 1231, 19, 7),
    ("R", 101, 201, 19, 7),
    ("R", 201, 302, 20, 7),
    ("R", 302, 409, 20, 6),
    ("R", 409, 415, 21, 6),
    ("R", 415, 826, 21, 5),
    ("R", 826, 902, 21, 6),
    ("R", 902, 1014, 20, 6),
    ("R", 1014, 1108, 19, 6),
    ("R", 1108, 1231, 19, 7),
    ("S", 101, 205, 19, 7),
    ("S", 205, 304, 20, 7),
    ("S", 304, 407, 20, 6),
    ("S", 407, 414, 21, 6),
    ("S", 414, 828, 21, 5),
    ("S", 828, 903, 21, 6),
    ("S", 903, 1013, 20, 6),
    ("S", 1013, 1104, 19, 6),
    ("S", 1104, 1231, 19, 7),
]

#: lags in hours per cluster and column
LAG_LISTS = {
    "cluster0": {
        "ta": [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 19, 20, 21, 22, 23, 24, 25, 26],
        "wd": [4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16, 17],
        "ws": [
            2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16, 17, 18, 19, 20, 21, 22, 23, 24, 25,
            26, 27, 28, 29,
        ],
        "rn_day": [22, 23, 24],
        "rn_hr1": [4],
        "hm": [1, 2, 3, 4, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16, 17, 18, 19, 24, 25, 26, 27, 28, 29],
        "si": [1, 2, 3, 4, 5, 9, 10, 11, 12, 13, 14, 15, 16, 17, 18, 19, 23, 24, 25, 26, 27, 28, 29],
        "ta_chi": [1, 30],
        "wd_rad": [4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16, 17],
        "wd_sin": [1, 2, 8, 9, 10, 11, 12, 13, 14, 15, 16, 17, 18, 19, 20, 21, 22, 23],
        "wd_cos": [3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16, 17, 18, 19, 23, 24, 25, 26, 27, 28],
    },
    "cluster1": {
        "ta": [1, 2, 3],
        "ws": [3, 4, 5],
    },
    "cluster2_summer": {
        "ta": [1, 2, 3, 8, 9, 10, 11],
        "rn_day": [10, 11, 12, 13, 14, 15, 16, 17, 18, 19, 20, 21, 22, 23, 24],
        "rn_hr1": [22, 23, 24],
        "hm": [1, 2, 3, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16, 17, 18, 19, 20, 21, 22, 23, 24],
        "si": [1, 2, 3, 4, 18, 19, 20, 21, 22, 23, 24],
        "ta_chi": [1, 2, 3, 23, 24],
        "year": [1, 2, 3, 4, 5],
        "month": [1, 2, 3, 4, 5],
        "day": [1, 2, 3, 4, 5, 6, 7, 20, 21, 22, 23, 24],
        "day_of_week": [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16, 20, 21, 22, 23, 24],
    },
    "cluster2_non_summer": {
        "ta": [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16, 17, 18, 19, 22, 23, 24],
        "wd": [1, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16, 17, 18, 19],
        "ws": [3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16, 17, 18, 19, 20, 21, 22, 23, 24],
        "rn_day": [9, 10, 11, 12, 13, 14, 15, 16, 17, 18, 19],
        "rn_hr1": [1, 3, 4, 5, 20, 21, 22, 23, 24],
        "hm": [5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16, 17, 18, 19, 20, 24],
        "si": [1, 2, 3, 4, 5, 6, 7, 9, 10, 11, 12, 13, 14, 15, 16, 17, 18, 19, 20, 21],
        "ta_chi": [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16, 17, 18, 19, 20, 21, 22, 23, 24],
        "month": [13, 14, 15, 16, 17, 18, 19, 20, 21, 22, 23, 24],
        "day": [8, 9, 10, 11, 12, 13, 14, 15, 16, 17, 18, 19, 20],
        "hour": [17],
        "day_of_week": [1, 2, 3, 4, 5, 6, 7, 8, 9, 18, 19, 20, 21, 22, 23, 24],
        "wd_rad": [1, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16, 17, 18, 19],
        "wd_sin": [1, 2, 6, 7, 8, 9, 10, 11, 12, 13, 14],
        "wd_cos": [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16, 17],
    },
    "cluster3": {
        "ta": [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 23, 24, 25],
        "wd": [9, 10, 11, 13, 14, 17, 18, 19],
        "ws": [5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16, 17, 18, 19, 20, 21, 22, 23, 24],
        "rn_day": [7, 8, 9, 10],
        "hm": [1, 2, 3, 4, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16, 17, 18, 19, 20, 21, 22],
        "si": [1, 2, 3, 4, 5, 9, 10, 11, 12, 13, 14, 15, 16, 17, 18, 19],
        "ta_chi": [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16, 17, 18, 19],
        "year": [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13],
        "day": [7, 8, 11, 12, 13, 14, 15],
        "hour": [13, 21, 25],
        "day_of_week": [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 23, 24, 25, 26, 27, 28],
        "hour_group": [1, 2, 3, 9],
        "wd_rad": [9, 10, 11, 12, 13, 17, 18],
        "wd_sin": [1, 2, 3, 4, 5, 10, 11, 12, 13, 14, 15, 16, 17, 18, 19, 20, 21, 22],
        "wd_cos": [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16],
    },
}
# ---- end of fixed values --------------------------------------------------

SITES = [site for site, _ in SITE_CLUSTERS]
CLUSTER_KEYS = tuple(LAG_LISTS)


def cluster_members(cluster: int) -> list[str]:
    return [site for site, number in SITE_CLUSTERS if number == cluster]


def cluster_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SITE_CLUSTERS, "branch_id string, cluster_id int")


def breakpoint_table(spark: SparkSession) -> DataFrame:
    rows = [(site, lo, hi) for site, (lo, hi) in TA_BREAKPOINTS.items()]
    return spark.createDataFrame(rows, "branch_id string, x0 double, x1 double")


def night_rule_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        NIGHT_RULES, "branch_id string, start_md int, end_md int, night_start int, night_end int"
    )
