"""Sample texts by language code, from which the built-in language profiles are trained.

Each is the first article of the Universal Declaration of Human Rights and, for most, a few sentences on a stay.
"""

from __future__ import annotations

# Fixed values.
SEED_TEXTS = {
    "en": """All human beings are born free and equal in dignity and rights. They are endowed with reason and conscience and should act towards
    one another in a spirit of brotherhood. The room was very clean and the staff were friendly, but breakfast was poor and we could not sleep because of the
    noise from the street. The bed is too hard, there is no hot water and the price is high. It was not what we expected, and this hotel has an old bathroom with a
    broken shower. I would have liked more choice for that money. Nothing worked in our apartment on the first night.""",
    "de": """Alle Menschen sind frei und gleich an Würde und Rechten geboren. Sie sind mit Vernunft und Gewissen begabt und sollen einander im Geiste der
    Brüderlichkeit begegnen. Das Zimmer war sehr sauber und das Personal freundlich, aber das Frühstück war schlecht und wir konnten wegen des Lärms von der Straße
    nicht schlafen. Das Bett ist zu hart, es gibt kein warmes Wasser und der Preis ist hoch. Es war nicht das, was wir erwartet hatten, und dieses Hotel hat ein altes Bad mit
    einer kaputten Dusche. Ich hätte mir für das Geld mehr Auswahl gewünscht. Nichts funktionierte in unserer Wohnung.""",
    "fr": """Tous les êtres humains naissent libres et égaux en dignité et en droits. Ils sont doués de raison et de conscience et doivent agir les uns envers
    les autres dans un esprit de fraternité. La chambre était très propre et le personnel aimable, mais le petit déjeuner était mauvais et nous ne pouvions pas dormir à cause du
    bruit de la rue. Le lit est trop dur, il n'y a pas d'eau chaude et le prix est élevé. Ce n'était pas ce que nous attendions, et cet hôtel a une vieille salle de bain avec une douche
    cassée. J'aurais voulu plus de choix pour cet argent. Rien ne marchait dans notre appartement.""",
    "es": """Todos los seres humanos nacen libres e iguales en dignidad y derechos y, dotados como están de razón y conciencia, deben comportarse fraternalmente
    los unos con los otros. La habitación estaba muy limpia y el personal era amable, pero el desayuno era malo y no pudimos dormir por el ruido de la calle. La cama es demasiado
    dura, no hay agua caliente y el precio es alto. No era lo que esperábamos, y este hotel tiene un baño viejo con una ducha rota. Me hubiera gustado más variedad por ese dinero. Nada
    funcionaba en nuestro apartamento.""",
    "pt": """Todos os seres humanos nascem livres e iguais em dignidade e em direitos. Dotados de razão e de consciência, devem agir uns para com os outros em
    espírito de fraternidade. O quarto estava muito limpo e os funcionários eram simpáticos, mas o pequeno-almoço era fraco e não conseguimos dormir por causa do barulho da rua. A cama
    é muito dura, não há água quente e o preço é alto. Não era o que esperávamos, e este hotel tem uma casa de banho velha. Nada funcionava no nosso apartamento.""",
    "it": """Tutti gli esseri umani nascono liberi ed eguali in dignità e diritti. Essi sono dotati di ragione e di coscienza e devono agire gli uni verso gli
    altri in spirito di fratellanza. La camera era molto pulita e il personale gentile, ma la colazione era scarsa e non abbiamo potuto dormire per il rumore della strada. Il letto è
    troppo duro, non c'è acqua calda e il prezzo è alto. Non era quello che ci aspettavamo, e questo albergo ha un bagno vecchio. Niente funzionava nel nostro appartamento.""",
    "ca": """Tots els éssers humans neixen lliures i iguals en dignitat i en drets. Són dotats de raó i de consciència, i han de comportar-se fraternalment els uns
    amb els altres. L'habitació era molt neta i el personal amable, però l'esmorzar era dolent i no vam poder dormir pel soroll del carrer. El llit és massa dur, no hi ha aigua calenta i el
    preu és alt. No era el que esperàvem, i aquest hotel té un bany vell. Res no funcionava al nostre apartament.""",
    "ro": """Toate ființele umane se nasc libere și egale în demnitate și în drepturi. Ele sunt înzestrate cu rațiune și conștiință și trebuie să se comporte unele
    față de altele în spiritul fraternității. Camera a fost foarte curată și personalul prietenos, dar micul dejun a fost slab și nu am putut dormi din cauza zgomotului de pe stradă. Patul este
    prea tare, nu este apă caldă și prețul este mare. Nu a fost ce ne așteptam. Nimic nu funcționa în apartamentul nostru.""",
    "nl": """Alle mensen worden vrij en gelijk in waardigheid en rechten geboren. Zij zijn begiftigd met verstand en geweten, en behoren zich jegens elkander in een
    geest van broederschap te gedragen. De kamer was erg schoon en het personeel vriendelijk, maar het ontbijt was slecht en we konden niet slapen door het lawaai van de straat. Het bed is te hard, er
    is geen warm water en de prijs is hoog. Het was niet wat wij verwachtten. Niets werkte in ons appartement.""",
    "af": """Alle menslike wesens word vry, met gelyke waardigheid en regte, gebore. Hulle het rede en gewete en behoort in die gees van broederskap teenoor mekaar op te
    tree. Die kamer was baie skoon en die personeel vriendelik, maar die ontbyt was swak en ons kon nie slaap nie weens die geraas van die straat.""",
    "sv": """Alla människor är födda fria och lika i värde och rättigheter. De har utrustats med förnuft och samvete och bör handla gentemot varandra i en anda av
    gemenskap. Rummet var mycket rent och personalen trevlig, men frukosten var dålig och vi kunde inte sova på grund av bullret från gatan. Sängen är för hård, det finns inget varmvatten och priset är
    högt. Det var inte vad vi väntade oss. Ingenting fungerade i vår lägenhet.""",
    "no": """Alle mennesker er født frie og med samme menneskeverd og menneskerettigheter. De er utstyrt med fornuft og samvittighet og bør handle mot hverandre i
    brorskapets ånd. Rommet var veldig rent og personalet hyggelig, men frokosten var dårlig og vi kunne ikke sove på grunn av støyen fra gaten. Sengen er for hard, det finnes ikke varmtvann og prisen
    er høy. Det var ikke det vi ventet oss. Ingenting virket i leiligheten vår.""",
    "da": """Alle mennesker er født frie og lige i værdighed og rettigheder. De er udstyret med fornuft og samvittighed, og de bør handle mod hverandre i en
    broderskabets ånd. Værelset var meget rent og personalet venligt, men morgenmaden var dårlig, og vi kunne ikke sove på grund af støjen fra gaden. Sengen er for hård, der er intet varmt vand, og
    prisen er høj. Det var ikke, hvad vi havde forventet. Intet virkede i vores lejlighed.""",
    "fi": """Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, ja heidän on toimittava toisiaan kohtaan
    veljeyden hengessä. Huone oli hyvin siisti ja henkilökunta ystävällistä, mutta aamiainen oli huono emmekä voineet nukkua kadun melun takia. Sänky on liian kova, lämmintä vettä ei ole ja hinta on korkea.""",
    "et": """Kõik inimesed sünnivad vabadena ja võrdsetena oma väärikuselt ja õigustelt. Neile on antud mõistus ja südametunnistus ja nende suhtumist üksteisesse peab
    kandma vendluse vaim. Tuba oli väga puhas ja teenindajad sõbralikud, kuid hommikusöök oli kehv ja me ei saanud tänavamüra tõttu magada. Voodi on liiga kõva, sooja vett ei ole ja hind on kõrge.""",
    "lv": """Visi cilvēki piedzimst brīvi un vienlīdzīgi savā pašcieņā un tiesībās. Viņi ir apveltīti ar saprātu un sirdsapziņu, un viņiem jāizturas citam pret citu
    brālības garā. Istaba bija ļoti tīra un personāls draudzīgs, bet brokastis bija sliktas un mēs nevarējām gulēt ielas trokšņa dēļ. Gulta ir pārāk cieta, nav silta ūdens un cena ir augsta.""",
    "lt": """Visi žmonės gimsta laisvi ir lygūs savo orumu ir teisėmis. Jiems suteiktas protas ir sąžinė ir jie turi elgtis vienas kito atžvilgiu kaip broliai.
    Kambarys buvo labai švarus ir personalas draugiškas, bet pusryčiai buvo prasti ir mes negalėjome miegoti dėl gatvės triukšmo. Lova per kieta, nėra karšto vandens, o kaina aukšta.""",
    "pl": """Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem i powinni postępować wobec innych w duchu
    braterstwa. Pokój był bardzo czysty, a obsługa miła, ale śniadanie było słabe i nie mogliśmy spać z powodu hałasu z ulicy. Łóżko jest za twarde, nie ma ciepłej wody, a cena jest wysoka. To nie było to, czego
    oczekiwaliśmy. Nic nie działało w naszym mieszkaniu. Brak miejsca do parkowania przy hotelu.""",
    "cs": """Všichni lidé rodí se svobodní a sobě rovní co do důstojnosti a práv. Jsou nadáni rozumem a svědomím a mají spolu jednat v duchu bratrství. Pokoj byl velmi
    čistý a personál přátelský, ale snídaně byla špatná a nemohli jsme spát kvůli hluku z ulice. Postel je příliš tvrdá, neteče teplá voda a cena je vysoká. Nebylo to, co jsme čekali. V našem bytě nic nefungovalo.""",
    "sk": """Všetci ľudia sa rodia slobodní a sebe rovní, čo sa týka ich dôstojnosti a práv. Sú obdarení rozumom a majú navzájom jednať v bratskom duchu. Izba bola veľmi
    čistá a personál priateľský, ale raňajky boli slabé a nemohli sme spať kvôli hluku z ulice. Posteľ je príliš tvrdá, netečie teplá voda a cena je vysoká. Nebolo to, čo sme čakali. V našom byte nič nefungovalo.""",
    "sl": """Vsi ljudje se rodijo svobodni in imajo enako dostojanstvo in enake pravice. Obdarjeni so z razumom in vestjo in bi morali ravnati drug z drugim kakor bratje. Soba
    je bila zelo čista in osebje prijazno, vendar je bil zajtrk slab in zaradi hrupa z ulice nismo mogli spati. Postelja je pretrda, ni tople vode in cena je visoka.""",
    "hr": """Sva ljudska bića rađaju se slobodna i jednaka u dostojanstvu i pravima. Ona su obdarena razumom i sviješću i trebaju jedna prema drugima postupati u duhu
    bratstva. Soba je bila vrlo čista i osoblje ljubazno, ali doručak je bio loš i nismo mogli spavati zbog buke s ulice. Krevet je pretvrd, nema tople vode i cijena je visoka. Nije bilo ono što smo očekivali.""",
    "sq": """Të gjithë njerëzit lindin të lirë dhe të barabartë në dinjitet dhe në të drejta. Ata kanë arsye dhe ndërgjegje dhe duhet të sillen ndaj njëri tjetrit me frymë
    vëllazërimi. Dhoma ishte shumë e pastër dhe stafi i sjellshëm, por mëngjesi ishte i dobët dhe nuk mund të flinim nga zhurma e rrugës.""",
    "hu": """Minden emberi lény szabadon születik és egyenlő méltósága és joga van. Az emberek, ésszel és lelkiismerettel bírván, egymással szemben testvéri szellemben kell hogy
    viseltessenek. A szoba nagyon tiszta volt és a személyzet kedves, de a reggeli gyenge volt és nem tudtunk aludni az utca zaja miatt. Az ágy túl kemény, nincs meleg víz és az ár magas. Nem ezt vártuk.""",
    "tr": """Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler ve birbirlerine karşı kardeşlik zihniyeti ile hareket etmelidirler. Oda
    çok temizdi ve personel güler yüzlüydü ama kahvaltı kötüydü ve sokaktan gelen gürültü yüzünden uyuyamadık. Yatak çok sert, sıcak su yok ve fiyat yüksek. Beklediğimiz gibi değildi.""",
    "id": """Semua orang dilahirkan merdeka dan mempunyai martabat dan hak-hak yang sama. Mereka dikaruniai akal dan hati nurani dan hendaknya bergaul satu sama lain dalam semangat
    persaudaraan. Kamar sangat bersih dan staf ramah, tetapi sarapan kurang enak dan kami tidak bisa tidur karena suara bising dari jalan. Tempat tidur terlalu keras, tidak ada air panas dan harganya mahal.""",
    "tl": """Ang lahat ng tao'y isinilang na malaya at pantay-pantay sa karangalan at mga karapatan. Sila'y pinagkalooban ng katwiran at budhi at dapat magpalagayan ang isa't isa sa
    diwa ng pagkakapatiran. Malinis ang silid at mabait ang mga tauhan, pero hindi masarap ang almusal at hindi kami nakatulog dahil sa ingay ng kalye.""",
    "sw": """Watu wote wamezaliwa huru, hadhi na haki zao ni sawa. Wote wamejaliwa akili na dhamiri, hivyo yapasa watendeane kindugu. Chumba kilikuwa safi sana na wafanyakazi walikuwa
    wakarimu, lakini kifungua kinywa hakikuwa kizuri na hatukuweza kulala kwa sababu ya kelele za barabarani.""",
    "vi": """Tất cả mọi người sinh ra đều được tự do và bình đẳng về nhân phẩm và quyền. Mọi con người đều được tạo hóa ban cho lý trí và lương tâm và cần phải đối xử với nhau trong tình bằng
    hữu. Phòng rất sạch và nhân viên thân thiện, nhưng bữa sáng không ngon và chúng tôi không ngủ được vì tiếng ồn ngoài đường. Giường quá cứng, không có nước nóng và giá cao.""",
    "cy": """Genir pawb yn rhydd ac yn gydradd â'i gilydd mewn urddas a hawliau. Fe'u cynysgaeddir â rheswm a chydwybod, a dylai pawb ymddwyn y naill at y llall mewn ysbryd cymodlon.""",
    "ru": """Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью и должны поступать в отношении друг друга в духе братства. Номер был очень чистый
    и персонал приветливый, но завтрак был плохой, и мы не могли спать из-за шума с улицы. Кровать слишком жёсткая, нет горячей воды, и цена высокая. Это было не то, что мы ожидали.""",
    "uk": """Всі люди народжуються вільними і рівними у своїй гідності та правах. Вони наділені розумом і совістю і повинні діяти у відношенні один до одного в дусі братерства. Номер був дуже чистий, а
    персонал привітний, але сніданок був поганий, і ми не могли спати через шум з вулиці. Ліжко надто тверде, немає гарячої води, і ціна висока. Це було не те, що ми очікували.""",
    "bg": """Всички хора се раждат свободни и равни по достойнство и права. Те са надарени с разум и съвест и следва да се отнасят помежду си в дух на братство. Стаята беше много чиста и персоналът любезен, но
    закуската беше слаба и не можахме да спим заради шума от улицата.""",
    "mk": """Сите човечки суштества се раѓаат слободни и еднакви по достоинство и права. Тие се обдарени со разум и совест и треба да се однесуваат еден кон друг во духот на општо човечката припадност.""",
    "el": """Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια και τα δικαιώματα. Είναι προικισμένοι με λογική και συνείδηση, και οφείλουν να συμπεριφέρονται μεταξύ τους με πνεύμα αδελφοσύνης.""",
    "he": """כל בני האדם נולדו בני חורין ושווים בערכם ובזכויותיהם. כולם חוננו בתבונה ובמצפון, לפיכך חובה עליהם לנהוג איש ברעהו ברוח של אחווה.""",
    "ar": """يولد جميع الناس أحرارا متساوين في الكرامة والحقوق. وقد وهبوا عقلا وضميرا وعليهم أن يعامل بعضهم بعضا بروح الإخاء. كانت الغرفة نظيفة جدا والموظفون لطفاء.""",
    "fa": """تمام افراد بشر آزاد به دنیا می‌آیند و از لحاظ حیثیت و حقوق با هم برابرند. همه دارای عقل و وجدان هستند و باید نسبت به یکدیگر با روح برادری رفتار کنند.""",
    "hi": """सभी मनुष्यों को गौरव और अधिकारों के मामले में जन्मजात स्वतन्त्रता और समानता प्राप्त है। उन्हें बुद्धि और अन्तरात्मा की देन प्राप्त है और परस्पर उन्हें भाईचारे के भाव से बर्ताव करना चाहिए।""",
    "ja": """すべての人間は、生まれながらにして自由であり、かつ、尊厳と権利とについて平等である。人間は、理性と良心とを授けられており、互いに同胞の精神をもって行動しなければならない。部屋はとても清潔でスタッフも親切でしたが、朝食は良くなく、通りの騒音で眠れませんでした。""",
    "ko": """모든 인간은 태어날 때부터 자유로우며 그 존엄과 권리에 있어 동등하다. 인간은 천부적으로 이성과 양심을 부여받았으며 서로 형제애의 정신으로 행동하여야 한다. 방은 매우 깨끗하고 직원들은 친절했지만 아침 식사는 별로였고 잠을 잘 수 없었습니다.""",
    "zh": """人人生而自由,在尊严和权利上一律平等。他们赋有理性和良心,并应以兄弟关系的精神相对待。房间很干净,工作人员很友好,但是早餐不好,因为街上的噪音我们睡不着。床太硬,没有热水,价格很高。""",
    "th": """มนุษย์ทั้งหลายเกิดมามีอิสระและเสมอภาคกันในเกียรติศักดิ์และสิทธิ ต่างมีเหตุผลและมโนธรรม และควรปฏิบัติต่อกันด้วยเจตนารมณ์แห่งภราดรภาพ""",
}
