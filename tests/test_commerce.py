from cohortia.operators import commerce
from tests.conftest import at, by_key, rows


def projects(make, rows_):
    full = [(i, i, at(c), company, False, "e", "t", 1, at(c), at(last), "s") for i, company, c, last in rows_]
    return make.table(
        "S_UUID string, ProjectName string, CreatedDate timestamp_ntz, CreatorCompanyPlatformName string, ProjectIsDeleted boolean, "
        "EnvironmentType string, AppType string, ProjectMemberCount int, FirstSandboxLogin timestamp_ntz, LastSandboxLogin timestamp_ntz, "
        "AppStatus string", full,
    )


def test_starter_apps(make):
    create = lambda p, t="2018-01-01 10:59:59": ("u", "TemplateBrowserProjectCreationSucceeded", t, None, "tpl", p)
    deploy = lambda p, t, kind="ModelDeployed": ("v", kind, t, p)
    events = make.events([
        create("p"), create("p"), create("quiet"), create("own"), create("unlisted"), create("nameless"),
        deploy("p", "2018-01-01 11:00:00"), deploy("p", "2018-01-02 11:00", "DeployAppPackage"), deploy("p", "2018-01-01 11:00:00", "WmDeployStarted"),
    ])
    known = projects(make, [("p", "Co", "2018-01-01 10:00", "2018-01-01 10:01"), ("quiet", "Co", "2018-01-01", None), ("own", "ACME", "2018-01-01", None), ("nameless", None, "2018-01-01", None)])
    got = commerce.starter_app_deploys(events, known, internal="acme")
    assert by_key(got, "ProjectID", "TimeDiffFirstDeploy", "TimeDiffLastDeploy", "NumberOfDeploys", "TimeDiffLastActiveDate") == {
        "p": (1, 1441, 2, 1), "quiet": (None, None, None, None),
    }


def test_carts(make):
    events = make.events([
        ("u", "MxShopCartCheckout", "2018-01-01 10:00", "o1"), ("u", "MxShopCartCheckout", "2018-01-01 10:00", "o1"), ("own", "MxShopCartCheckout", "2018-01-01", "o2"),
        ("ghost", "MxShopCartCheckout", "2018-01-01", "o3"), (None, "MxShopCartCheckout", "2018-01-01", "o4"),
        ("u", "MxShopItemAddedToCart", "2018-01-01", "l1", "s", "2"), ("ghost", "MxShopItemDeletedFromCart", "2018-01-01", "l2", "s", "1"),
        ("own", "MxShopItemAddedToCart", "2018-01-01", "l3", "s", "2", "Acme"), ("u", "MxShopItemAddedToCart", "2018-01-01", "l4", "s", "2", None),
    ])
    users = make.users([("u", "C1", "2018-01-01"), ("own", "Acme", "2018-01-01")])
    assert rows(commerce.cart_checkouts_per_user(events, users, internal="acme"), "OrderId") == [("o1",), ("o1",)]
    assert rows(commerce.cart_events(events, internal="acme"), "OrderLineId", "Quantity") == [("l1", "2"), ("l2", "1")]
