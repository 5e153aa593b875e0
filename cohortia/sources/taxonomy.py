"""Event vocabulary.  Fixed values: they must equal the names in the event log.

Every operator takes its lists as arguments; these are the usual ones.  The
event recorded for a review of the product carries the product's own name, so
it is passed in: ``activity_types("Acme")`` adds ``AcmeReviewAdded``.
"""

from __future__ import annotations

# Signup
FORM_VISIT = "MemberSignupFormVisit"
SIGNUP_STARTED = "MemberSignupStartedExtended"
SIGNUP_COMPLETED = "MemberSignupCompleted"
EMAIL_SENT = "SignupConfirmationEmailSentSuccessful"
SIGNUP_STEP = "MemberSignupStep"
INVITE_REASONS = ("App Invitation", "Platform Invitation", "Project Invitation")
SIGNUP_STEP_FLAGS = {
    "OptimizeExperiencePage": "OptimizeExperiencePage",
    "AgreeToEmail": "AgreeToEmail",
    "ProjectCreated": "Project created, forwarding user",
}

# Guidance
TUTORIAL_STEP = "WmIntroTutorialStep"
TUTORIAL_BROKEN = "WmIntroTutorialBroken"
TOUR_STARTED = "GuidanceTourStarted"
TOUR_ENDED = "GuidanceTourEnded"
WELCOME_STEP = "welcome1"
FINISHED_STEP = "Finished"
CONTINUE_PREFIX = "Continue"
CONTINUE_LEARN = "Continue with learn"
CONTINUE_IN_APP = "Continue working in app"

# Challenges
CHALLENGE_ASSIGNED = "ChallengeAssigned"
CHALLENGE_COMPLETED = "ChallengeCompleted"
CHALLENGE_EXPIRED = "ChallengeExpired"
CHALLENGE_CLAIMED = "ChallengeCreditClaimed"
CHALLENGE_EVENTS = (
    CHALLENGE_ASSIGNED, CHALLENGE_COMPLETED, CHALLENGE_EXPIRED, CHALLENGE_CLAIMED,
)

# Activation, lectures, invites
ACTIVATION = ("SandboxDeployed", "WmDeploySucceeded")
LECTURE_COMPLETED = "OnlineLectureCompleted"
LECTURES = ("OnlineLectureStarted", "OnlineLectureCompleted")
INVITES = ("AppInviteSent", "PlatformInviteSent", "ProjectInviteSent", "ReferralInviteSent")

# Starter apps and shop
TEMPLATE_CREATED = "TemplateBrowserProjectCreationSucceeded"
DEPLOYS = ("WmDeploySucceeded", "SandboxDeployed", "ModelDeployed", "DeployAppPackage")
CART_ADDED = "MxShopItemAddedToCart"
CART_DELETED = "MxShopItemDeletedFromCart"
CART_CHECKOUT = "MxShopCartCheckout"

# Event types kept in the minimised event table
INITIATIVE_EVENTS = (
    FORM_VISIT, SIGNUP_STARTED, SIGNUP_COMPLETED, EMAIL_SENT, SIGNUP_STEP,
    TUTORIAL_BROKEN, TUTORIAL_STEP, TOUR_STARTED, TOUR_ENDED,
    "SandboxDeployed", "WmDeploySucceeded", LECTURE_COMPLETED,
)


def review_event(product: str) -> str:
    """Name of the review event of ``product``."""
    return f"{product}ReviewAdded"


def growth_types(product: str) -> list[str]:
    """Events that count as activity for the key growth metrics."""
    return [
        "OnlineLectureStarted", "TrainingAppLogin", "AppLogin", "AppPublished",
        "AppReviewAdded", "AppDownload", "BlogpostAdded", review_event(product),
        "ModelerDownloaded", "ModelshareDownloaded", "ModelshareUploaded",
        "TeamserverCommit", "DevPortalVisit", "LaunchpadVisit", "MessagePosted",
        "PostCreated", "ProjectCreated", "StoryCreated", "SuccessfulModelerLogin",
        "ViewAppClicked", "FeedbackItemReplied", "FeedbackItemCreated",
        "AnswerPosted", "CommentPosted", "QuestionPosted", "AppInviteSent",
        "PlatformInviteSent", "ProjectInviteSent", "ModelDeployed", "CommentAdded",
        "SandboxDeployed", "EditInWebmodelerClicked", "WmProjectOpened",
        "WmDeploySucceeded", "ReferralInviteSent",
    ]


def activity_types(product: str) -> list[str]:
    """Events that count as platform activity for existing and new users."""
    return [
        "OnlineCourseStarted", "OnlineLectureStarted", "OnlineModuleStarted",
        "OnlineCourseCompleted", "OnlineLectureCompleted", "OnlineModuleCompleted",
        "AppLogin", "AppNewVersion", "AppPublished", "AppReviewAdded", "AppDownload",
        "BlogpostAdded", "MeetupAttended", "MeetupOrganized", review_event(product),
        "ModelerDownloaded", "SandboxDeployed", "WmDeploySucceeded",
        "TeamserverCommit", "SuccessfulModelerLogin", "ModelDeployed",
        "DevPortalVisit", "LaunchpadVisit", "MessagePosted", "PostCreated",
        "PostLiked", "PostUnliked", "ProjectCreated", "StoryCreated",
        "ViewAppClicked", "AcceptedAnswerRemoved", "AnswerPosted", "LikedQuestion",
        "MarkedAnswerAsAccepted", "QuestionPosted", "Upvoted", "UpvoteRemoved",
        "AppInviteSent", "PlatformInviteSent", "ProjectInviteSent", "CommentAdded",
        "CommentLiked", "EditInWebmodelerClicked", "WmProjectOpened",
    ]


# Onboarding categories.  Only types that the onboarding event load contains
# count, so the download, message and feedback types of the wider lists do not.
ONBOARDING = {
    "Dev": (
        "SandboxDeployed", "WmDeploySucceeded", "TeamserverCommit",
        "SuccessfulModelerLogin", "ModelDeployed",
    ),
    "Learn": (
        "OnlineCourseStarted", "OnlineLectureStarted", "OnlineModuleStarted",
        "OnlineCourseCompleted", "OnlineLectureCompleted", "OnlineModuleCompleted",
    ),
    "Other": ("StoryCreated", "ProjectInviteSent", "CommentAdded", "QuestionPosted"),
}


def challenge_categories(product: str) -> dict[str, tuple[str, ...]]:
    """Activity categories compared before and after challenges."""
    return {
        "Dev": (
            "EditInWebmodelerClicked", "TeamserverCommit", "ViewAppClicked",
            "ModelDeployed", "SandboxDeployed", "WmDeployStarted",
            "WmProjectOpened", "ModelerDownloaded",
        ),
        "Learn": LECTURES,
        "Explore": ("QuestionPosted", "CommentPosted"),
        "Share": ("AppPublished", "DocumentationAdded", "BlogpostAdded", "AnswerPosted"),
        "Social": (
            "CompleteUserProfile", "ConnectionInviteAccepted", "ConnectionInviteSent",
            "ConnectMeetupAccount", review_event(product), "ReferralInviteSent",
            "SetUserProfileToPublic",
        ),
    }
