"""Threshold rules as CASE expressions. A missing level is never above a threshold."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .. import config
from ..config import Rules


def _graded(level: Column, rules: Rules, critical: str, warning: str, normal: str) -> Column:
    return (
        F.when(level > rules.critical, critical).when(level > rules.warning, warning).otherwise(normal)
    )


def status(level: Column, rules: Rules = Rules()) -> Column:
    return _graded(
        level, rules, config.STATUS_CRITICAL, config.STATUS_WARNING, config.STATUS_NORMAL
    )


def feed_label(level: Column, rules: Rules = Rules()) -> Column:
    return _graded(level, rules, config.FEED_CRITICAL, config.FEED_WARNING, config.FEED_NORMAL)


def is_alert(level: Column, rules: Rules = Rules()) -> Column:
    return level > rules.warning


def alert_message(level: Column, rules: Rules = Rules()) -> Column:
    return F.when(level > rules.critical, config.MESSAGE_CRITICAL).otherwise(config.MESSAGE_WARNING)
