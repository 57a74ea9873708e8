"""Text lines of the reports."""

from pyspark.sql import Column, functions as F

# Wording of the report lines, equal to what consumers read today.
CLONED_PLATE = "涉嫌套牌车"
TOP_HEAD = "在窗口%d ----%d 时间范围内:整个城市最拥堵的前%d个卡口是:"
TOP_ITEM = "卡口:%s,经过的车辆数量为:%d,平均车速为:%s"
AREA_COUNT = "区域%s,在窗口其实时间%d,到窗口结束时间%d ,一共有%d 辆车"
DANGEROUS_HEAD = "该车辆涉嫌危险驾驶,"
DANGEROUS_ITEM = "第%d个经过卡口是:%s -->"
HANDLED = "车辆%s,已经有交警出警了，警号为:%s,出警的状态是：%s,出警的时间:%d"
MATCHED = "该违法车辆%s，违法时间%d,已经有交警出警了，警号为:%s,出警的状态是：%s,出警的时间:%d"
NO_VIOLATION_LABEL = "没有对应的违法车辆信息"
NO_POLICE_LABEL = "该违法车辆在5分钟内没有交警出警"


def top_line(start, end, n: int, items: Column) -> Column:
    """``items``: array of structs (monitor_id, car_count, avg_speed) in rank order."""
    rows = F.transform(items, lambda r: F.format_string(
        TOP_ITEM, r["monitor_id"], r["car_count"], r["avg_speed"].cast("string")))
    return F.concat(F.format_string(TOP_HEAD, start, end, F.lit(n)), F.array_join(rows, ""), F.lit("\n"))


def area_line(area, start, end, count) -> Column:
    return F.format_string(AREA_COUNT, area, start, end, count)


def dangerous_line(monitors: Column) -> Column:
    """``monitors``: array of checkpoint ids in driving order."""
    steps = F.transform(monitors, lambda m, i: F.format_string(DANGEROUS_ITEM, i + 1, m))
    return F.concat(F.lit(DANGEROUS_HEAD), F.array_join(steps, ""))


def handled_line(car, police_id, status, time) -> Column:
    return F.format_string(HANDLED, car, police_id, status, time)


def matched_line(car, violation_time, police_id, status, time) -> Column:
    return F.format_string(MATCHED, car, violation_time, police_id, status, time)
