"""Headings of the yearly survey files and the metric each one stands for."""

from __future__ import annotations

# Fixed values: (first year, last year, heading, metric).  Headings drift from one vintage to the next.
INCOME_HEADINGS = [
    (2015, 2017, "Households!!Estimate!!Median income (dollars)", "median_household_income"),
    (2015, 2017, "Households!!Margin of Error!!Median income (dollars)", "median_income_error"),
    (2015, 2017, "Households!!Estimate!!Mean income (dollars)", "mean_household_income"),
    (2015, 2017, "Households!!Margin of Error!!Mean income (dollars)", "mean_income_error"),
    (2018, 2018, "Estimate!!Households!!Median income (dollars)", "median_household_income"),
    (2018, 2018, "Margin of Error!!Households MOE!!Median income (dollars)", "median_income_error"),
    (2018, 2018, "Estimate!!Households!!Mean income (dollars)", "mean_household_income"),
    (2018, 2018, "Margin of Error!!Households MOE!!Mean income (dollars)", "mean_income_error"),
    (2019, 9999, "Estimate!!Households!!Median income (dollars)", "median_household_income"),
    (2019, 9999, "Margin of Error!!Households!!Median income (dollars)", "median_income_error"),
    (2019, 9999, "Estimate!!Households!!Mean income (dollars)", "mean_household_income"),
    (2019, 9999, "Margin of Error!!Households!!Mean income (dollars)", "mean_income_error"),
]

# The last part of each poverty heading and its metric.
POVERTY_GROUPS = [
    ("AGE!!Under 18 years", "pov_children"),
    ("AGE!!18 to 64 years", "pov_adult"),
    ("EDUCATIONAL ATTAINMENT!!Population 25 years and over!!Less than high school graduate", "pov_no_hs"),
    ("EDUCATIONAL ATTAINMENT!!Population 25 years and over!!Bachelor's degree or higher", "pov_bach"),
    ("EMPLOYMENT STATUS!!Civilian labor force 16 years and over!!Employed", "pov_employed"),
    ("WORK EXPERIENCE!!Population 16 years and over!!Did not work", "pov_no_work"),
]
# Fixed values: (first year, last year, start of the estimate heading, start of the error heading).
POVERTY_VINTAGES = [
    (2015, 2017, "Percent below poverty level!!Estimate!!", "Percent below poverty level!!Margin of Error!!"),
    (
        2018,
        2018,
        "Estimate!!Percent below poverty level!!Population for whom poverty status is determined!!",
        "Margin of Error!!Percent below poverty level MOE!!Population for whom poverty status is determined!!",
    ),
    (
        2019,
        9999,
        "Estimate!!Percent below poverty level!!Population for whom poverty status is determined!!",
        "Margin of Error!!Percent below poverty level!!Population for whom poverty status is determined!!",
    ),
]

POVERTY_HEADINGS = [
    heading
    for first, last, estimate, error in POVERTY_VINTAGES
    for group, metric in POVERTY_GROUPS
    for heading in ((first, last, estimate + group, metric), (first, last, error + group, metric + "_error"))
]
