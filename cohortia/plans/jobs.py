"""Report jobs: read base tables, run operators, write report tables.

Each job reads the base tables under ``source`` and earlier reports under
``target``.  A report that later jobs need is written first and read back, so
its work is done once and its lineage ends at the table.  Run order:
``initiatives``, ``signups``, then the rest in any order.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from cohortia.operators import (
    challenges, commerce, existing, experiments, growth, onboarding, signup, tours,
)
from cohortia.sources import tables, taxonomy


@dataclass(frozen=True)
class Settings:
    """Where tables live and what the reports are about.

    ``internal`` is the part of company names and addresses that marks the own
    company, ``product`` the prefix of its review event, ``question`` the signup
    question that decides the customer type.  The reports cover what is later than
    ``growth_since`` (growth metrics), ``log_since`` (the reduced log) and
    ``new_users_since``, and challenges within ``challenges_between``.  With a
    ``collation`` all texts compare by it; reports hold them as the source writes them.
    """

    source: str
    target: str
    internal: str
    product: str
    question: str
    as_of: dt.datetime
    growth_since: dt.date
    log_since: dt.date
    new_users_since: dt.date
    challenges_between: tuple[dt.datetime, dt.datetime]
    excluded_owners: tuple[str, ...] = ()
    log_partition: str = "day"
    collation: str | None = None


class Jobs:
    """The report jobs of one run."""

    def __init__(self, spark: SparkSession, settings: Settings):
        self.spark, self.s = spark, settings

    # --- tables ---------------------------------------------------------------

    def base(self, name: str) -> DataFrame:
        return self._compared(tables.read_table(self.spark, self.s.source, name))

    def report(self, name: str) -> DataFrame:
        return self._compared(tables.read_table(self.spark, self.s.target, name))

    def replace(self, name: str, rows: DataFrame) -> None:
        tables.replace_table(self._stored(rows), self.s.target, name)

    def staged(self, name: str, rows: DataFrame) -> DataFrame:
        return self._compared(tables.staged(self._stored(rows), self.s.target, name))

    def initiative_log(self) -> DataFrame:
        return self._compared(
            tables.read_event_log(self.spark, self.s.target, "initiatives_events")
        )

    def _compared(self, rows: DataFrame) -> DataFrame:
        return tables.collated(rows, self.s.collation) if self.s.collation else rows

    def _stored(self, rows: DataFrame) -> DataFrame:
        return tables.exact(rows) if self.s.collation else rows

    # --- jobs -----------------------------------------------------------------

    def initiatives(self) -> None:
        """The reduced event log and the key growth metrics."""
        events = self.base("platform_event")
        tables.write_event_log(
            self._stored(growth.initiative_events(events, after=self.s.log_since)),
            self.s.target, "initiatives_events",
            by=self.s.log_partition,
        )
        types = taxonomy.growth_types(self.s.product)
        users = growth.growth_users(self.base("user_current"), internal=self.s.internal)
        self.replace(
            "initiatives_kgm",
            growth.key_growth_metrics(
                users, growth.growth_events(events, types=types, after=self.s.growth_since),
                self.base("company_current"),
                internal=self.s.internal, retention_types=types,
            ),
        )

    def signups(self) -> None:
        """Allocation, funnels, form answers, customer types, leads, new users."""
        log, internal = self.initiative_log(), self.s.internal
        kgm = self.report("initiatives_kgm")
        self.replace("signup_experiment_allocation", signup.experiment_allocation(log))
        self.replace("signup_funnel", signup.signup_step_funnel(log, internal=internal))
        answers = self.staged("signup_answers", signup.form_answers(log, internal=internal))
        self.replace("signup_pageinfo_full", signup.page_info_daily(answers))
        self.replace(
            "customer_types", signup.customer_types(answers, log, question=self.s.question)
        )
        joined = signup.signup_with_growth(
            signup.signup_funnel_by_visit(log, internal=internal), kgm, as_of=self.s.as_of
        )
        leads = signup.qualified_leads(
            self.base("user_lead"), self.base("lead_current"), internal=internal,
            excluded_owners=self.s.excluded_owners,
        )
        self.replace("signup_full", signup.signup_full(joined, self.report("customer_types"), leads))
        self.replace(
            "new_users",
            signup.new_users(
                self.base("user_current"), log, kgm, self.base("company_current"), internal=internal,
                since=self.s.new_users_since,
            ),
        )

    def significance(self) -> None:
        """Today's test results, added to the two histories."""
        log, kgm = self.initiative_log(), self.report("initiatives_kgm")
        visits = signup.signup_with_growth(
            signup.signup_funnel_by_visit(
                log, internal=self.s.internal, profile=[], dedupe=False, cap_visits=False,
                copies="Copies",
            ),
            kgm, as_of=self.s.as_of, visit_before_signup=False, with_retained=False,
        )
        conversion = tours.tour_conversion(tours.tour_progress(log), log)
        guided = tours.tour_output(
            conversion, kgm, as_of=self.s.as_of, not_experiment="1",
            continued=tours.tour_continue(log),
        )
        for name, rows, date, metrics, weight in (
            ("signup_significance", visits, "FirstSignupPageVisit", experiments.SIGNUP_METRICS, "Copies"),
            ("tour_significance", guided, "FirstStartDate", experiments.TOUR_METRICS, None),
        ):
            long = experiments.unpivot_metrics(
                rows, date_column=date, metrics=metrics, weight=weight
            )
            results = experiments.active_experiments(
                experiments.ab_significance(long, as_of=self.s.as_of, weight=weight),
                self.base("experiment_current"),
            )
            tables.append_day(self._stored(results), self.s.target, name, value=self.s.as_of.date())

    def guided_tours(self) -> None:
        """Tutorial reports in their three forms, and flow conversion."""
        log, kgm = self.initiative_log(), self.report("initiatives_kgm")
        types = self.report("customer_types")
        progress = tours.tour_progress(log)
        started = tours.tour_conversion(progress, log)
        finished = tours.tour_conversion(progress, log, anchor="finish")
        continued, broken = tours.tour_continue(log), tours.tour_broken(log)
        self.replace(
            "tour_full",
            tours.tour_output(started, kgm, as_of=self.s.as_of, continued=continued, broken=broken),
        )
        self.replace(
            "tour_output",
            tours.tour_output(
                finished, kgm, as_of=self.s.as_of, continued=continued, customer_types=types,
                require_finished=True, not_experiment="1",
            ),
        )
        self.replace(
            "tour_journey_4",
            tours.tour_output(
                started, kgm, as_of=self.s.as_of, broken=broken, customer_types=types,
                experiment="journey_4",
            ),
        )
        self.replace("flow_conversions", tours.flow_conversion(log))

    def products(self) -> None:
        """Onboarding, existing and resurrected users, invite conversion."""
        events, users = self.base("platform_event"), self.base("user_current")
        company, months = self.base("company_current"), self.base("users_month")
        activity, internal = taxonomy.activity_types(self.s.product), self.s.internal
        people = onboarding.onboarding_users(users, events, company, internal=internal)
        self.replace("onboarding_new_users", onboarding.onboarding(people, events, activity=activity))
        rows = self.staged(
            "existing_user_churn",
            existing.existing_user_churn_flags(
                existing.monthly_existing_users(
                    months, users, events, types=activity, internal=internal
                ),
                as_of=self.s.as_of,
            ),
        )
        self.replace("existing_users", existing.existing_users_certified(rows, users))
        self.replace("existing_users_year", existing.existing_users_by_year(rows, users))
        self.replace(
            "resurrected_users",
            existing.resurrection(months, users, as_of=self.s.as_of, internal=internal),
        )
        self.replace(
            "invite_conversion",
            growth.invite_conversion(users, events, internal=internal, as_of=self.s.as_of),
        )

    def challenge_reports(self, before_after_prefix: str) -> dict[str, DataFrame]:
        """Challenge progress and claims as tables; the three ad-hoc results
        are returned as rows."""
        events, users = self.base("platform_event"), self.base("user_current")
        categories = taxonomy.challenge_categories(self.s.product)
        internal = self.s.internal
        self.replace(
            "challenges_progress",
            challenges.challenge_progress_output(
                challenges.challenge_progress(events), users, internal=internal
            ),
        )
        self.replace(
            "challenges_credits", challenges.credits_claimed(events, users, internal=internal)
        )
        self.replace("challenges_credits_full", challenges.credits_claimed_raw(events))
        return {
            "activity": challenges.challenge_activity(
                self.report("challenges_progress"), events, categories=categories,
                between=self.s.challenges_between,
            ),
            "profile": challenges.challenge_user_profile(
                events, users, self.base("company_current"), self.base("gamification"),
                categories=categories, as_of=self.s.as_of, after=self.s.challenges_between[0],
            ),
            "before_after": challenges.before_after_activity(
                events, users, challenge_prefix=before_after_prefix, internal=internal,
                as_of=self.s.as_of, after=self.s.challenges_between[0],
            ),
        }

    def shop(self) -> None:
        """Starter-app deploys and cart tables."""
        events, internal = self.base("platform_event"), self.s.internal
        self.replace(
            "starter_apps",
            commerce.starter_app_deploys(events, self.base("projects"), internal=internal),
        )
        self.replace(
            "cart_checkouts",
            commerce.cart_checkouts_per_user(events, self.base("user_current"), internal=internal),
        )
        self.replace("cart_events", commerce.cart_events(events, internal=internal))
