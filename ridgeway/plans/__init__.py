"""Batch jobs composed from the operators: one function per delivered table.

Every job takes source frames and a cohort and returns a frame. ``periods`` is
``None`` (all rows), a pair of days, or a calendar from
:func:`ridgeway.operators.calendar.plan_periods`; with a calendar all periods
are computed in one job and ``period_start``/``period_end`` lead the keys.
"""
