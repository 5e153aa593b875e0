"""Facts shared by both bindings: event lists and fixed report settings.

The benchmark tables are read as follows.

* ``customer`` rows are users, ``supplier`` rows companies, ``part`` rows leads,
  ``region`` rows tracked experiments.
* ``events`` rows are user events placed around the user's signup: day ``d`` of
  the table becomes day ``3d - 5`` after signup.
* ``orders`` rows are signup events and, in a second reading, project and shop
  events; ``lineitem`` rows are long-run activity of user ``l_partkey``.
  Dates move 20 years forward.

All rules are arithmetic on the keys of single rows, so they scale with the
tables.  Some users are blank, unknown or internal, and some payloads are
missing or malformed, on purpose.
"""

import datetime as dt

INTERNAL = "acme"
PRODUCT = "Acme"
QUESTION = "Where does your journey start?"
AS_OF = dt.datetime(2019, 12, 15, 9, 30)
# What the reports cover; fixed values.
GROWTH_SINCE = dt.date(2017, 12, 1)
LOG_SINCE = dt.date(2016, 12, 1)
NEW_USERS_SINCE = dt.date(2017, 1, 1)
CHALLENGES_BETWEEN = dt.datetime(2018, 11, 1), dt.datetime(2019, 1, 1)

RELATIVE_TYPES = [
    "WmIntroTutorialStep", "WmIntroTutorialStep", "WmIntroTutorialStep",
    "WmIntroTutorialStep", "WmIntroTutorialBroken", "OnlineLectureCompleted",
    "SandboxDeployed", "WmDeploySucceeded", "GuidanceTourStarted",
    "GuidanceTourEnded", "ChallengeAssigned", "ChallengeAssigned",
    "ChallengeCompleted", "ChallengeExpired", "ChallengeCreditClaimed",
    "AppInviteSent", "ProjectInviteSent", "ReferralInviteSent",
    "OnlineLectureStarted", "TeamserverCommit", "QuestionPosted", "AnswerPosted",
    "CompleteUserProfile", "StoryCreated",
]
SIGNUP_TYPES = [
    "MemberSignupFormVisit", "MemberSignupStartedExtended", "MemberSignupCompleted",
    "SignupConfirmationEmailSentSuccessful", "MemberSignupStep", "MemberSignupStep",
]
ACTIVITY_TYPES = [
    "TeamserverCommit", "SandboxDeployed", "WmDeploySucceeded", "ModelDeployed",
    "DeployAppPackage", "AppLogin", "OnlineCourseStarted", "PostCreated",
    "DevPortalVisit", "UpvoteRemoved", "AcmeReviewAdded", "WmDeployStarted",
    "EditInWebmodelerClicked", "BlogpostAdded", "UnlistedEvent",
]
SHOP_TYPES = [
    "TemplateBrowserProjectCreationSucceeded", "MxShopItemAddedToCart",
    "TemplateBrowserProjectCreationSucceeded", "MxShopItemDeletedFromCart",
    "TemplateBrowserProjectCreationSucceeded", "MxShopCartCheckout",
]
STEPS = ["welcome1", "step2", "step3", "Finished", "Continue with learn", "Continue working in app"]
TUTORIALS = [
    "journey_A:4", "journey_B:4", "journey_A:3", "journey_B:3", "journey_C:4", "plain", "x:1",
]
OUTCOMES = ["completed", "Closed", "closed", "other"]
REASONS = ["App Invitation", "Platform Invitation", "Project Invitation", "Other"]
PAGES = [
    "JourneyPage", "OptimizeExperiencePage", "AgreeToEmail", "Project created, forwarding user",
]
