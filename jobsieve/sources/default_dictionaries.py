"""Default dictionaries: job-title aliases, skill aliases, topics and cloud services.

Users replace them with their own JSON files (see ``sources.dictionaries``).
"""

# The entries below must stay exactly as they are for results to match.

TITLE_ALIASES = {
    "front end dev": "frontend dev",
    "front-end dev": "frontend dev",
    "frontend developer": "frontend dev",
    "front end developer": "frontend dev",
    "front-end developer": "frontend dev",
    "front end programmer": "frontend dev",
    "front-end programmer": "frontend dev",
    "frontend programmer": "frontend dev",
    "sviluppatore frontend": "frontend dev",
    "sviluppatore front end": "frontend dev",
    "sviluppatore front-end": "frontend dev",
    "programmatore frontend": "frontend dev",
    "programmatore front end": "frontend dev",
    "programmatore front-end": "frontend dev",
    "back end dev": "backend dev",
    "back-end dev": "backend dev",
    "backend developer": "backend dev",
    "back end developer": "backend dev",
    "back-end developer": "backend dev",
    "back end programmer": "backend dev",
    "back-end programmer": "backend dev",
    "backend programmer": "backend dev",
    "sviluppatore backend": "backend dev",
    "sviluppatore back end": "backend dev",
    "sviluppatore back-end": "backend dev",
    "programmatore backend": "backend dev",
    "programmatore back end": "backend dev",
    "programmatore back-end": "backend dev",
    "full stack dev": "fullstack dev",
    "full-stack dev": "fullstack dev",
    "fullstack developer": "fullstack dev",
    "full stack developer": "fullstack dev",
    "full-stack developer": "fullstack dev",
    "full stack programmer": "fullstack dev",
    "full-stack programmer": "fullstack dev",
    "fullstack programmer": "fullstack dev",
    "sviluppatore fullstack": "fullstack dev",
    "sviluppatore full stack": "fullstack dev",
    "sviluppatore full-stack": "fullstack dev",
    "programmatore fullstack": "fullstack dev",
    "programmatore full stack": "fullstack dev",
    "programmatore full-stack": "fullstack dev",
    "mobile developer": "mobile dev",
    "sviluppatore mobile": "mobile dev",
    "programmatore mobile": "mobile dev",
    "mobile application developer": "mobile dev",
    "mobile app developer": "mobile dev",
    "app developer": "mobile dev",
    "android developer": "android dev",
    "ios developer": "ios dev",
    "mobile programmer": "mobile dev",
    "mobile application programmer": "mobile dev",
    "mobile app programmer": "mobile dev",
    "app programmer": "mobile dev",
    "android programmer": "android dev",
    "ios programmer": "ios dev",
    "data analytics": "data analyst",
    "data analysis": "data analyst",
    "analista dati": "data analyst",
    "business data analyst": "data analyst",
    "business analyst": "data analyst",
    "machine learning engineer": "ml engineer",
    "artificial intelligence engineer": "ai engineer",
    "machine learning developer": "ml dev",
    "artificial intelligence developer": "ai dev",
    "machine learning programmer": "ml dev",
    "artificial intelligence programmer": "ai dev",
    "cloud infrastructure engineer": "cloud engineer",
    "cloud developer": "cloud dev",
    "cloud programmer": "cloud dev",
    "cloud solutions architect": "cloud architect",
    "information security engineer": "security engineer",
    "infosec engineer": "security engineer",
    "application security engineer": "app security engineer",
    "appsec engineer": "app security engineer",
    "quality assurance engineer": "qa engineer",
    "user experience designer": "ux designer",
    "user interface designer": "ui designer",
    "game developer": "game dev",
    "game programmer": "game dev",
    "database administrator": "db administrator",
    "database engineer": "db engineer",
}

SKILL_ALIASES = {
    "node": "node.js",
    "nodejs": "node.js",
    "node js": "node.js",
    "node-js": "node.js",
    "node. js": "node.js",
    "reactjs": "react",
    "react js": "react",
    "react.js": "react",
    "react-js": "react",
    "vue": "vue.js",
    "vuejs": "vue.js",
    "vue js": "vue.js",
    "vue-js": "vue.js",
    "next": "next.js",
    "nextjs": "next.js",
    "next js": "next.js",
    "next-js": "next.js",
    "nest": "nest.js",
    "nestjs": "nest.js",
    "nest js": "nest.js",
    "nest-js": "nest.js",
    "nuxt": "nuxt.js",
    "nuxtjs": "nuxt.js",
    "nuxt js": "nuxt.js",
    "nuxt-js": "nuxt.js",
    "angularjs": "angular",
    "angular js": "angular",
    "angular.js": "angular",
    "angular-js": "angular",
    "express": "express.js",
    "expressjs": "express.js",
    "express js": "express.js",
    "express-js": "express.js",
    "tailwindcss": "tailwind",
    "tailwind css": "tailwind",
    "tailwind.css": "tailwind",
    "ts": "typescript",
    "type script": "typescript",
    "react-native": "react native",
    "reactnative": "react native",
    "springboot": "spring boot",
    "spring-boot": "spring boot",
    "jakarta ee": "java ee",
    "java enterprise edition": "java ee",
    "java persistence api": "jpa",
    "python3": "python",
    "python 3": "python",
    "py": "python",
    "sklearn": "scikit-learn",
    "scikit": "scikit-learn",
    "tensor flow": "tensorflow",
    "amazon web services": "aws",
    "simple notification service": "sns",
    "simple queue service": "sqs",
    "relational database service": "rds",
    "simple storage service": "s3",
    "elastic kubernetes service": "eks",
    "elastic container service": "ecs",
    "elastic load balancing": "elb",
    "sage maker": "sagemaker",
    "elasticbeanstalk": "beanstalk",
    "elastic beanstalk": "beanstalk",
    "aurora": "aurora db",
    "aws cdk": "cdk",
    "gcp": "google cloud platform",
    "google cloud": "google cloud platform",
    "pubsub": "pub/sub",
    "composer": "cloud composer",
    "kubernetes engine": "gke",
    "google kubernetes engine": "gke",
    "google cloud storage": "cloud storage",
    "gcs": "cloud storage",
    "gcp stack driver": "stack driver",
    "google cloud stack driver": "stack driver",
    "azure cloud": "azure",
    "microsoft azure": "azure",
    "azure blob storage": "blob storage",
    "cosmos db": "cosmosdb",
    "azure cosmos db": "cosmosdb",
    "azure databricks": "databricks",
    "azure machine learning": "azure ml",
    "azure kubernetes service": "aks",
    "active directory": "azure ad",
    "entra id": "azure ad",
    "microsoft entra id": "azure ad",
    "datalake storage": "data lake storage",
    "azure data lake storage": "data lake storage",
    "azure adls": "data lake storage",
    "adls": "data lake storage",
    "postgres": "postgresql",
    "postgre sql": "postgresql",
    "postgres sql": "postgresql",
    "mongo": "mongodb",
    "mongo db": "mongodb",
    "mongo-db": "mongodb",
    "ms sql server": "sql server",
    "microsoft sql server": "sql server",
    "powerbi": "power bi",
    "power-bi": "power bi",
    "pbi": "power bi",
    "bi": "power bi",
    "ms power bi": "power bi",
    "microsoft power bi": "power bi",
    "powerquery": "power query",
    "power-query": "power query",
    "m language": "power query",
    "powerapps": "power apps",
    "power-apps": "power apps",
    "microsoft power apps": "power apps",
    "powerautomate": "power automate",
    "power-automate": "power automate",
    "microsoft flow": "power automate",
    "ms flow": "power automate",
    "powerpages": "power pages",
    "power-pages": "power pages",
    "power-virtual-agents": "power virtual agents",
    "powervirtualagents": "power virtual agents",
    "sap businessobjects": "business object",
    "sap bo": "business object",
    "businessobjects": "business object",
    "apache spark": "spark",
    "spark-sql": "spark sql",
    "sparksql": "spark sql",
    "py spark": "pyspark",
    "py-spark": "pyspark",
    "mllib": "spark mllib",
    "spark ml": "spark mllib",
    "sparkml": "spark mllib",
    "spark-ml": "spark mllib",
    "spark machine learning": "spark mllib",
    "spark-streaming": "spark streaming",
    "sparkstreaming": "spark streaming",
    "structured streaming": "spark streaming",
    "graphx": "spark graphx",
    "spark-graphx": "spark graphx",
    "sparkgraphx": "spark graphx",
    "git hub": "github",
    "git lab": "gitlab",
    "k8s": "kubernetes",
    "k8": "kubernetes",
    "vb": "visual basic",
    "vb.net": "visual basic",
    "vb .net": "visual basic",
    "swiftui": "swift ui",
    "swift-ui": "swift ui",
    "visual studio code": "vs code",
    "vscode": "vs code",
    "golang": "go",
    "go lang": "go",
    "go-lang": "go",
    "dotnet": ".net",
    "dot net": ".net",
    ". net": ".net",
    "c #": "c#",
    "csharp": "c#",
    "c-sharp": "c#",
    "cpp": "c++",
    "c + +": "c++",
    "c ++": "c++",
    "shell script": "shell",
    "shell scripting": "shell",
    "elk stack": "elk",
    "looker studio": "looker",
    "sense": "qliksense",
    "db2": "ibm db2",
}

TOPICS = {
    "cloud_providers": [
        "aws", "gcp", "azure", "ibm", "oracle",
    ],
    "programming_languages": [
        "python", "java", "javascript", "typescript", "c#", "c++", "c", "go", "rust", "ruby", "php",
        "swift", "kotlin", "scala", "r", "matlab", "perl", "visual basic", "objective-c", "dart",
        "elixir", "haskell", "lua", "groovy", "cobol", "fortran", "assembly", "sql", "bash",
        "powershell", "shell",
    ],
    "frontend_frameworks": [
        "react", "angular", "vue.js", "svelte", "next.js", "nuxt.js", "gatsby", "ember.js",
        "backbone.js", "jquery", "preact", "solid.js", "alpine.js", "htmx", "lit", "react native",
        "flutter", "ionic", "xamarin", "swift ui", "swiftui", "jetpack compose", "tailwind",
        "bootstrap", "material ui", "quasar", "sass", "less", "styled-components", "css modules",
    ],
    "backend_frameworks": [
        "django", "flask", "fastapi", "spring framework", "spring boot", "express.js", "nest.js",
        "asp.net", ".net", ".net framework", "laravel", "symfony", "ruby on rails", "rails", "gin",
        "echo", "fiber", "actix", "rocket", "phoenix", "play framework", "grails", "struts", "ktor",
        "micronaut", "quarkus", "dropwizard",
    ],
    "databases": [
        "postgresql", "mysql", "sql server", "oracle", "mariadb", "sqlite", "cockroachdb",
        "timescaledb", "yugabytedb", "mongodb", "redis", "cassandra", "couchbase", "couchdb",
        "dynamodb", "aurora db", "rds", "cosmos db", "neo4j", "arangodb", "influxdb",
        "elasticsearch", "memcached", "riak",
    ],
    "devops_tools": [
        "docker", "kubernetes", "terraform", "ansible", "puppet", "chef", "vagrant", "packer",
        "consul", "vault", "nomad", "helm", "kustomize", "argocd", "flux", "jenkins", "circleci",
        "travis ci", "bamboo", "teamcity", "octopus deploy", "spinnaker",
    ],
    "testing_frameworks": [
        "pytest", "unittest", "jest", "mocha", "jasmine", "junit", "testng", "selenium", "cypress",
        "playwright", "puppeteer", "cucumber", "rspec", "phpunit", "karma", "protractor", "enzyme",
        "react testing library", "vitest", "testing library",
    ],
}

CLOUD_SERVICES = {
    "aws": [
        "s3", "ec2", "lambda", "dynamodb", "rds", "sqs", "sns", "cloudformation", "cloudwatch",
        "iam", "vpc", "route53", "beanstalk", "ecs", "eks", "fargate", "glue", "athena", "kinesis",
        "redshift", "aurora db", "emr", "sagemaker", "step functions", "api gateway", "cognito",
        "cloudfront", "elb", "alb", "nlb", "eventbridge", "secrets manager", "systems manager",
        "codepipeline", "codebuild", "codecommit", "codedeploy", "cdk", "aws config",
        "aws control tower",
    ],
    "gcp": [
        "bigquery", "cloud storage", "compute engine", "cloud functions", "cloud run", "dataflow",
        "pub/sub", "firestore", "cloud sql", "cloud spanner", "dataproc", "cloud composer",
        "cloud build", "artifact registry", "container registry", "gke", "app engine",
        "cloud tasks", "cloud scheduler", "cloud memorystore", "bigtable", "datastore", "vertex ai",
        "cloud vision", "cloud natural language", "cloud translate", "cloud logging",
        "cloud monitoring", "cloud trace", "cloud profiler", "stack driver",
    ],
    "azure": [
        "azure functions", "blob storage", "cosmosdb", "azure sql", "event hubs", "service bus",
        "azure databricks", "azure synapse", "azure ml", "aks", "app service", "azure devops",
        "azure pipelines", "azure storage", "azure data factory", "azure stream analytics",
        "azure logic apps", "azure monitor", "application insights", "azure key vault", "azure ad",
        "azure container instances", "azure batch", "azure hdinsight", "azure redis cache",
        "table storage", "queue storage", "azure boards", "data lake storage", "bicep",
    ],
    "ibm": [
        "ibm cloud", "ibm watson", "watson", "cloud foundry", "ibm db2", "ibm cloud functions",
        "ibm cloud object storage", "ibm kubernetes service", "ibm cloud pak", "cloudant",
        "ibm cloud database", "ibm cloud messaging", "ibm event streams",
    ],
    "oracle": [
        "oracle cloud", "oci", "oracle cloud infrastructure", "oracle database",
        "oracle autonomous database", "ibm doors",
    ],
}
