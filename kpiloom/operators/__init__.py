from kpiloom.operators.aggregates import *  # noqa: F401,F403
from kpiloom.operators.filters import *  # noqa: F401,F403
from kpiloom.operators.joins import *  # noqa: F401,F403
from kpiloom.operators.ordering import *  # noqa: F401,F403
from kpiloom.operators.periods import *  # noqa: F401,F403
from kpiloom.operators.states import *  # noqa: F401,F403
